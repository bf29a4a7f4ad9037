import public_tokenizers
from tokenizers import Tokenizer

from slotwise.llm import token_scan

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_counts_match_the_library(spark, sf, tmp_path):
    library = Tokenizer.from_file(PATH)
    library.encode_special_tokens = True
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    token_scan.write_tokens(docs.repartition(3), str(tmp_path / "t"), PATH)
    wanted = {r.doc_id: len(library.encode(r.text or "", add_special_tokens=False).ids) for r in docs.collect()}
    # Blocks of any size give the same counts: documents cross them.
    for block in (token_scan.BLOCK_TOKENS, 1000, 7):
        out = token_scan.scan(spark, str(tmp_path / "t"), block_tokens=block).collect()
        assert {r.doc_id: r.n_tokens for r in out} == wanted and len(out) == len(wanted)
    total = token_scan.totals(token_scan.scan(spark, str(tmp_path / "t"))).agg({"n_tokens": "sum", "n_docs": "sum"}).first()
    assert sorted(total) == sorted([sum(wanted.values()), len(wanted)])


def test_odd_rows(spark, tmp_path):
    rows = [(None, "a"), (0, None), (-1, ""), (2**63 - 1, "x<|endoftext|>y"), (-2**63, "b c"), (5, "d"), (5, "d")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, tokens int")
    token_scan.write_tokens(docs, str(tmp_path / "t"), PATH, docs_per_file=2)
    out = token_scan.scan(spark, str(tmp_path / "t")).collect()
    assert sorted(((r.doc_id, r.n_tokens) for r in out), key=repr) == sorted(
        [(None, 1), (0, 0), (-1, 0), (2**63 - 1, 9), (-2**63, 2), (5, 1), (5, 1)], key=repr)
    token_scan.write_tokens(docs.limit(0), str(tmp_path / "none"), PATH)
    assert token_scan.scan(spark, str(tmp_path / "none")).count() == 0


def test_a_last_document_without_an_end_counts(spark, tmp_path):
    import numpy as np

    folder = tmp_path / "flat"
    folder.mkdir()
    end = token_scan.END
    (folder / "a.bin").write_bytes(np.array([1, 2, end, end, 3], "<u2").tobytes())
    for block in (1, 2, 3, 100):
        out = token_scan.scan(spark, str(folder), with_keys=False, block_tokens=block).orderBy("number").collect()
        assert [(r.number, r.n_tokens, r.first_token) for r in out] == [(0, 2, 0), (1, 0, 3), (2, 1, 4)]
