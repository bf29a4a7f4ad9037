"""How the sources of a language differ in their use of words, and which words set each source apart.

Terms are runs of letters A to Z and of code points beyond ASCII, only A to Z lower-cased. A language keeps the V terms that
occur in at least ``LEAST_DOCUMENTS`` of its documents. In a group (a language and source) or a whole language of N kept
occurrences, a term of ``count`` occurrences has p = 1 + floor(1000000000 * (count + 2) / (N + 2 * V)), in exact decimals.
Two such values differ by f = floor((p - q)^2 / (p + q)), whose square stays below 2^63.

* Part ``pair``: f summed over all kept terms, for each two sources of a language. Terms are dealt into blocks by a hash;
  a block is a table of terms by sources in one task, filled with the p of zero, and gives one partial sum per pair of
  sources, never a row per pair and term. There are as many blocks as keep such a table at about ``CELLS`` cells.
* Part ``term``: the kept terms of a group with p above the language's q, by f, to rank 10. Which rank first is decided by
  dominance: f grows with the group's count and falls with the language's, and ties go to the earlier UTF-8, so a term that
  ``TOP`` others dominate (count no lower, language count no higher, earlier in UTF-8) cannot be among the first ``TOP``.
  Partitions keep the skyband of the rest and prune it as they read; skybands of a group are merged, in shares and then
  whole, and only what is left is valued and ranked exactly.

Every row is a document, also repeated ones and those that share an id. Null text, lang and source count as ''. Groups
without terms are there with N = 0, and a language without kept terms has V = 0 and pair values of 0. Extra columns are not
read; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotwise.llm.common import chosen, stored

# Fixed values of the report.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"  # what parts terms
LEAST_DOCUMENTS, TOP, SCALE, PRIOR = 10, 10, 1_000_000_000, 2
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

HELD = 50_000  # rows of skybands that a task holds before it prunes them
SHARES = 16  # a group's skybands are merged in so many shares first
CELLS = 500_000  # expected of a block, terms by sources


def documents_of(docs: DataFrame) -> DataFrame:
    """``lang``, ``source`` and ``text`` without nulls."""
    return chosen(docs, **{c: F.coalesce(docs[f"`{c}`"].cast("string"), F.lit("")) for c in ("lang", "source", "text")})


def kept_terms(rows: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """``lang, source, term, n, lang_n``: occurrences of kept terms in groups that have them, and in their language."""
    # Cutting between terms costs a fraction of extracting them; it leaves empty strings at the ends.
    words = F.sort_array(F.split(F.translate("text", CAPITALS, SMALL), BETWEEN))
    # Sorted, a document's first occurrence of a term is one that differs from the word before, so that documents are
    # counted by addition. No word list is empty; "outer" spares a filter that would cut the text a second time to see it.
    each = rows.select("lang", "source", words.alias("words")).select(
        "lang", "source", "words", F.posexplode_outer("words").alias("at", "term")).filter("term <> ''")
    first = ~F.get("words", F.col("at") - 1).eqNullSafe(F.col("term"))
    counts = each.groupBy("lang", "source", "term").agg(F.count("*").alias("n"), F.count_if(first).alias("documents"))
    # A row per source of a term: the window holds pre-aggregated rows only.
    over = W.partitionBy("lang", "term")
    counts = counts.withColumns({"lang_n": F.sum("n").over(over), "lang_documents": F.sum("documents").over(over)})
    return counts.filter(F.col("lang_documents") >= least).select("lang", "source", "term", "n", "lang_n")


def proportion(count: str, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * terms)) of named columns, exact at any size of counts."""
    wide = "cast({} as decimal(20,0))".format
    return F.expr(
        f"1 + ({wide(count)} + {PRIOR}) * {SCALE}BD div ({wide(total)} + {PRIOR} * {wide(terms)})")


def totals(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """``lang, source, group_total, lang_total, terms`` of every group that occurs."""
    groups = rows.select("lang", "source").distinct()
    of_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("group_total"))
    of_lang = kept.groupBy("lang", "term").agg(F.sum("n").alias("n")).groupBy("lang").agg(
        F.sum("n").alias("lang_total"), F.count("*").alias("terms"))
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("group_total", "lang_total", "terms")}
    return groups.join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left").withColumns(zero)


# --- the terms that set a source apart


def undominated(count: np.ndarray, lang_count: np.ndarray, place: np.ndarray, k: int = TOP) -> np.ndarray:
    """Which rows fewer than ``k`` others dominate: count no lower, lang_count no higher, place earlier.

    Rows are taken in an order in which dominators come first. A row that ``k`` rows dominate needs no counting for
    others: what it dominates is dominated by those ``k`` as well, so that counting it changes nothing either.
    """
    order = np.lexsort((place, lang_count, -count))
    keep = np.zeros(len(order), bool)
    langs, places = np.empty(len(order), lang_count.dtype), np.empty(len(order), place.dtype)
    size = 0
    for low in range(0, len(order), 256):
        part = order[low:low + 256]
        # Against the rows kept of earlier parts, then of those left against the ones before them in the same part.
        beaten = ((langs[:size] <= lang_count[part, None]) & (places[:size] < place[part, None])).sum(axis=1)
        part, beaten = part[beaten < k], beaten[beaten < k]
        lang, at = lang_count[part], place[part]
        part = part[beaten + np.tril((lang <= lang[:, None]) & (at < at[:, None]), -1).sum(axis=1) < k]
        keep[part] = True
        langs[size:size + len(part)], places[size:size + len(part)] = lang_count[part], place[part]
        size += len(part)
    return keep


def skyband(rows: DataFrame, k: int = TOP) -> DataFrame:
    """Rows that fewer than ``k`` others of their group and partition dominate, or some more: never fewer."""
    names = ["lang", "source", "term", "n", "lang_n"]

    def pruned(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        place = np.empty(table.num_rows, np.int64)
        place[pc.sort_indices(table["term"]).to_numpy()] = np.arange(table.num_rows)  # Arrow orders strings by UTF-8
        count, lang_count = table["n"].to_numpy(), table["lang_n"].to_numpy()
        keys = table.select(["lang", "source"]).append_column("row", pa.array(np.arange(table.num_rows)))
        keys = keys.sort_by([("lang", "ascending"), ("source", "ascending")])
        row = keys["row"].to_numpy()
        codes = [pc.dictionary_encode(keys[c].combine_chunks()).indices.to_numpy() for c in ("lang", "source")]
        new = np.r_[True, (np.diff(codes[0]) != 0) | (np.diff(codes[1]) != 0)]
        keep = np.zeros(table.num_rows, bool)
        for at in np.split(row, np.flatnonzero(new)[1:]):
            keep[at] = undominated(count[at], lang_count[at], place[at], k)
        return table.filter(pa.array(keep))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size, limit = 0, HELD
        for batch in batches:
            if batch.num_rows:
                held.append(pa.Table.from_batches([batch]))
                size += batch.num_rows
            if size >= limit:
                held = [pruned(pa.concat_tables(held))]
                size = held[0].num_rows
                if size > HELD // 2:  # many groups: what is left goes on, and is pruned again after the next shuffle
                    yield from held[0].to_batches(max_chunksize=10_000)
                    held, size = [], 0
        if held:
            yield from pruned(pa.concat_tables(held)).to_batches(max_chunksize=10_000)

    schema = "lang string, source string, term string, n long, lang_n long"
    return rows.select(*names).mapInArrow(run, schema)


def top_terms(kept: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """Part ``term``: local skybands, merged twice, then exact values and ranks of what is left."""
    local = skyband(kept, top)
    share = F.pmod(F.xxhash64("term"), F.lit(SHARES))
    merged = skyband(local.repartition("lang", "source", share), top)
    merged = skyband(merged.repartition("lang", "source"), top)
    valued = merged.join(groups, ["lang", "source"]).withColumns({
        "p": proportion("n", "group_total", "terms"), "q": proportion("lang_n", "lang_total", "terms"),
    }).filter("p > q")
    valued = valued.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                           F.expr("(p - q) * (p - q) div (p + q)").alias("value"))
    return ranked(valued).filter(F.col("rank") <= top)


# --- the differences of sources


def block_sums(rows: pa.Table) -> pa.Table:
    """Sums of differences over the terms of a block, for every two sources, the smaller first.

    Rows without a term name the block's sources and their p of zero; the others have p of a term.
    """
    heads = rows.filter(pc.is_null(rows["term"])).sort_by("source")
    facts = rows.filter(pc.is_valid(rows["term"]))
    sources = heads["source"].combine_chunks()
    terms = pc.dictionary_encode(facts["term"].combine_chunks())
    table = np.tile(heads["p"].to_numpy(), (len(terms.dictionary), 1))
    column = pc.index_in(facts["source"].combine_chunks(), value_set=sources)
    table[terms.indices.to_numpy(), column.to_numpy()] = facts["p"].to_numpy()
    lang, found = rows["lang"][0].as_py(), []
    for a in range(len(sources) - 1):
        one, rest = table[:, a:a + 1], table[:, a + 1:]
        gap = one - rest
        values = (gap * gap // (one + rest)).sum(axis=0)
        n = len(values)
        found.append(pa.table({
            "lang": pa.array([lang] * n, pa.string()), "source": pa.array([sources[a].as_py()] * n, pa.string()),
            "item": sources[a + 1:], "value": pa.array(values, pa.int64())}))
    empty = pa.table({"lang": pa.array([], pa.string()), "source": pa.array([], pa.string()),
                      "item": pa.array([], pa.string()), "value": pa.array([], pa.int64())})
    return pa.concat_tables([empty, *found])


def pair_values(kept: DataFrame, groups: DataFrame, cells: int = CELLS) -> DataFrame:
    """Part ``pair``: summed differences of every two sources of a language, both ways."""
    zero = F.lit(0).cast("long")
    blocks = F.ceil(F.col("terms") * F.count("*").over(W.partitionBy("lang")) / cells).cast("long")
    described = groups.filter("terms > 0").withColumn("none", zero).select(
        "lang", "source", "group_total", "terms", blocks.alias("blocks"),
        proportion("none", "group_total", "terms").alias("p"))
    # Every block learns of all sources of its language; a term's block is drawn by its hash.
    heads = described.select("lang", F.explode(F.sequence(zero, F.col("blocks") - 1)).alias("block"),
                             F.lit(None).cast("string").alias("term"), "source", "p")
    facts = kept.join(described.drop("p"), ["lang", "source"]).select(
        "lang", F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block"), "term", "source",
        proportion("n", "group_total", "terms").alias("p"))
    halves = heads.unionByName(facts).groupBy("lang", "block").applyInArrow(
        block_sums, "lang string, source string, item string, value long")
    halves = halves.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    # Languages without kept terms differ by nothing.
    plain = groups.filter("terms = 0").select("lang", "source")
    other = plain.select("lang", F.col("source").alias("item"))
    nothing = plain.join(other, "lang").filter("source <> item").withColumn("value", zero)
    turned = halves.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    every = reduce(DataFrame.unionByName, [halves, turned, nothing.select("lang", "source", "item", "value")])
    return ranked(every.select("lang", "source", F.lit("pair").alias("part"), "item", "value"))


def ranked(rows: DataFrame) -> DataFrame:
    order = W.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return rows.select("lang", "source", "part", "item", "value", F.row_number().over(order).cast("int").alias("rank"))


def audit(docs: DataFrame) -> DataFrame:
    """Both parts of the report over all documents."""
    rows = documents_of(docs)
    kept = stored(kept_terms(rows), "kept-terms")
    groups = stored(totals(rows, kept), "term-totals")
    return pair_values(kept, groups).unionByName(top_terms(kept, groups))


AUDIT_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
w AS (SELECT i, lang, source, unnest(words) AS term FROM d),
vocabulary AS (SELECT lang, term, count(*)::HUGEINT AS lang_n FROM w GROUP BY lang, term HAVING count(DISTINCT i) >= 10),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(lang_n)::HUGEINT AS total FROM vocabulary GROUP BY lang),
counts AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM w JOIN vocabulary USING (lang, term) GROUP BY lang, source, term),
sizes AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM counts GROUP BY lang, source),
grid AS (SELECT g.lang, g.source, v.term, coalesce(c.n, 0) AS n, v.lang_n,
    1 + (1000000000 * (coalesce(c.n, 0) + 2)) // (coalesce(s.total, 0) + 2 * l.v) AS p,
    1 + (1000000000 * (v.lang_n + 2)) // (l.total + 2 * l.v) AS q
  FROM (SELECT DISTINCT lang, source FROM d) g JOIN vocabulary v USING (lang) JOIN langs l USING (lang)
  LEFT JOIN sizes s USING (lang, source) LEFT JOIN counts c USING (lang, source, term)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM grid a JOIN grid b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
  UNION ALL
  SELECT a.lang, a.source, b.source, 0 FROM (SELECT DISTINCT lang, source FROM d) a JOIN (SELECT DISTINCT lang, source FROM d) b
    ON a.lang = b.lang AND a.source <> b.source WHERE a.lang NOT IN (SELECT lang FROM langs)),
parts AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM grid WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM r WHERE part = 'pair' OR rank <= 10
"""
