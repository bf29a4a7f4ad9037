import re

from slotwise.llm import licenses


def test_base_columns_match_a_plain_version(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in licenses.scan(docs).collect()}
    for doc_id, text in docs.select("doc_id", "text").collect():
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        found = [(i, label) for phrase, label in licenses.PHRASES.items() for p in [phrase.split()]
                 for i in range(len(words)) if words[i:i + len(p)] == p]
        starts = [i for i, _ in found]
        r = got.pop(doc_id)
        base = sorted({label for _, label in found})
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (
            len(words), len(found), min(starts, default=None), max(starts, default=None), ",".join(base))
        assert set(base) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1
    assert not got


def by_hand(text):
    """Rules, suppression and the gate, written plainly."""
    found = []
    for r in licenses.rules():
        if r["keyword"] in text.lower():
            pattern = re.compile(r["regex"], re.ASCII)
            found += [(m.start(), -m.end(), -r["priority"], r["label"], r["weight"]) for m in pattern.finditer(text)]
    found.sort()
    kept = []
    for n, d in enumerate(found):
        if not any(e[1] <= d[1] and e[2] <= d[2] for e in found[:n]):
            kept.append(d)
    return ",".join(sorted({d[3] for d in kept})), max([d[4] for d in kept], default=0.0)


TEXTS = [
    "SPDX-License-Identifier: MIT", "Licensed under the Apache License, Version 2.0.", "Released under the MIT License.",
    "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.",
    "mit license mit license\nMIT LICENSE", "the GNU Affero General Public License", "license: BSD-3-Clause (see file)",
    "Distributed under the terms of the Eclipse Public License, v2.0", "we went under the bridge", "permit licenses", "",
    "x " * 3000 + "Released under the MIT License. " * 50,
]


def test_rules_match_a_plain_version(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for r in licenses.scan(docs).collect():
        labels, best = by_hand(TEXTS[r.doc_id])
        base = set(filter(None, r.base_labels.split(",")))
        assert set(filter(None, r.labels.split(","))) == base | set(filter(None, labels.split(","))), TEXTS[r.doc_id][:80]
        assert r.score == max(best, 0.5 if base else 0.0)


def test_rule_table():
    table = licenses.rules()
    assert len(table) >= 200 and all(re.compile(r["regex"]) for r in table)
    assert all(0 <= r["priority"] < licenses.LEVELS for r in table)


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "MIT License")], "doc_id long, text string")
    plan = licenses.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "InArrow" not in plan and "InPandas" not in plan


def test_odd_rows(spark):
    rows = [(None, None, "x"), (1, "", "y"), (2, "MIT License", "z"), (2, "MIT License", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, labels string")
    got = licenses.scan(docs).collect()
    assert sorted((r.n_words, r.n_base, r.labels) for r in got) == [(0, 0, ""), (0, 0, ""), (2, 1, "mit"), (2, 1, "mit")]
    assert licenses.scan(docs.limit(0)).count() == 0


NAMES = {
    "0bsd": ["Zero-Clause BSD"], "afl-3.0": ["Academic Free"], "agpl-3.0": ["GNU Affero General Public"],
    "apache-1.1": ["Apache Software License, Version 1.1"], "apache-2.0": ["Apache License, Version 2.0", "Apache 2.0"],
    "artistic-1.0": ["Artistic License 1.0"], "artistic-2.0": ["Artistic 2.0"],
    "bsd-2-clause": ["Simplified BSD", "BSD 2-Clause", "2-clause BSD"],
    "bsd-3-clause": ["New BSD", "revised BSD", "BSD-3-Clause", "3 clause BSD"],
    "bsd-4-clause": ["original BSD", "BSD 4 clause", "4-clause BSD"], "bsl-1.0": ["Boost Software"],
    "cc0-1.0": ["CC0 1.0", "Creative Commons Zero"], "cc-by-3.0": ["CC BY 3.0", "Creative Commons Attribution 3.0"],
    "cc-by-4.0": ["CC-BY-4.0", "Creative Commons Attribution 4.0"],
    "cc-by-sa-3.0": ["CC BY-SA 3.0", "Creative Commons Attribution-ShareAlike 3.0"],
    "cc-by-sa-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0"],
    "cc-by-nc-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0"],
    "cc-by-nd-4.0": ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0"],
    "cc-by-nc-sa-4.0": ["CC BY-NC-SA 4.0"], "cc-by-nc-nd-4.0": ["CC BY-NC-ND 4.0"],
    "cddl-1.0": ["Common Development and Distribution"], "cecill-2.1": ["CeCILL 2.1", "CECILL"],
    "cpl-1.0": ["Common Public License 1.0"], "curl": ["curl license"], "epl-1.0": ["Eclipse Public License, version 1.0"],
    "epl-2.0": ["Eclipse Public License - v2.0"], "eupl-1.2": ["European Union Public"], "gfdl-1.3": ["GNU Free Documentation"],
    "gpl-1.0": ["GNU General Public License, version 1"], "gpl-2.0": ["General Public License v2"],
    "gpl-3.0": ["GNU General Public License, version 3"], "isc": ["ISC License"],
    "lgpl-2.1": ["GNU Lesser General Public License, version 2.1", "Library General Public License v2"],
    "lgpl-3.0": ["GNU Lesser General Public License, version 3"], "libpng": ["libpng license"],
    "lppl-1.3c": ["LaTeX Project Public"], "mit": ["MIT", "Expat License"], "mpl-1.1": ["Mozilla Public License 1.1"],
    "mpl-2.0": ["Mozilla Public License, version 2.0"], "ms-pl": ["Microsoft Public"], "ms-rl": ["Microsoft Reciprocal"],
    "mulan-psl-2.0": ["Mulan Permissive Software"], "ncsa": ["NCSA", "University of Illinois Open Source"],
    "odbl-1.0": ["Open Database", "Open Data Commons Open Database"], "ofl-1.1": ["SIL Open Font"], "openssl": ["OpenSSL License"],
    "osl-3.0": ["Open Software"], "php-3.01": ["PHP License"], "postgresql": ["PostgreSQL License"],
    "python-2.0": ["Python Software Foundation License", "Python License"], "qpl-1.0": ["Q Public"], "ruby": ["Ruby License"],
    "sleepycat": ["Sleepycat"], "unlicense": ["The Unlicense", "Unlicense"], "upl-1.0": ["Universal Permissive"],
    "vim": ["Vim License"], "wtfpl": ["WTFPL", "Do What The Fuck You Want To Public"], "x11": ["X11 License"],
    "zlib": ["zlib License"],
}


def ungated(text):
    """Labels and best weight of all rules, none of them held back by a keyword."""
    found = sorted(
        (m.start(), -m.end(), -r["priority"], r["label"], r["weight"])
        for r in licenses.rules() for m in re.finditer(r["regex"], text, re.ASCII))
    kept = [d for n, d in enumerate(found) if not any(e[1] <= d[1] and e[2] <= d[2] for e in found[:n])]
    return {d[3] for d in kept}, max([d[4] for d in kept], default=0.0)


def test_keywords_hold_back_no_match(spark):
    assert set(NAMES) == {label for label, *_ in licenses.LICENSES}
    assert not any(re.search(r"\s", r["keyword"]) for r in licenses.rules())
    cases = []
    for label, names in NAMES.items():
        for name in names:
            for form in ("Licensed under the {}.", "terms: {}", "the {} License"):
                text = form.format(name)
                cases += [(label, form, t) for t in (text, text.replace(" ", "\n"), text.upper().replace(" ", " \n\t"))]
    cases += [(label, "id", f"SPDX-License-Identifier: {spdx}") for label, _, spdx, _ in licenses.LICENSES]
    docs = spark.createDataFrame([(i, t) for i, (*_, t) in enumerate(cases)], "doc_id long, text string")
    for r in licenses.scan(docs.repartition(8)).collect():
        label, form, text = cases[r.doc_id]
        labels, best = ungated(text)
        base = set(filter(None, r.base_labels.split(",")))
        assert set(filter(None, r.labels.split(","))) == base | labels, text
        assert r.score == max(best, 0.5 if base else 0.0), text
        if form != "the {} License":
            assert label in labels, text


PLAIN_TITLES = {
    "0bsd": "BSD Zero Clause License", "afl-3.0": "Academic Free License", "agpl-3.0": "GNU AFFERO GENERAL PUBLIC LICENSE\n Version 3",
    "apache-1.1": "Apache Software License, Version 1.1", "apache-2.0": "Apache License\n  Version 2.0, January 2004",
    "artistic-1.0": "The Artistic License 1.0", "artistic-2.0": "Artistic License 2.0",
    "bsd-2-clause": "BSD 2-Clause License", "bsd-3-clause": "BSD 3-Clause License", "bsd-4-clause": "BSD 4-Clause License",
    "bsl-1.0": "Boost Software License", "cc0-1.0": "CC0 1.0 Universal", "cc-by-3.0": "Creative Commons Attribution 3.0 Unported",
    "cc-by-4.0": "Creative Commons Attribution 4.0 International", "cc-by-sa-3.0": "Creative Commons Attribution-ShareAlike 3.0 Unported",
    "cc-by-sa-4.0": "Creative Commons Attribution-ShareAlike 4.0 International",
    "cc-by-nc-4.0": "Creative Commons Attribution-NonCommercial 4.0 International",
    "cc-by-nd-4.0": "Creative Commons Attribution-NoDerivatives 4.0 International",
    "cc-by-nc-sa-4.0": "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International",
    "cc-by-nc-nd-4.0": "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International",
    "cddl-1.0": "Common Development and Distribution License", "cecill-2.1": "CeCILL FREE SOFTWARE LICENSE AGREEMENT",
    "cpl-1.0": "Common Public License Version 1.0", "curl": "curl License", "epl-1.0": "Eclipse Public License - v 1.0",
    "epl-2.0": "Eclipse Public License - v 2.0", "eupl-1.2": "European Union Public Licence", "gfdl-1.3": "GNU Free Documentation License",
    "gpl-1.0": "GNU GENERAL PUBLIC LICENSE Version 1, February 1989", "gpl-2.0": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "gpl-3.0": "GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007", "isc": "The ISC License",
    "lgpl-2.1": "GNU LESSER GENERAL PUBLIC LICENSE\n   Version 2.1, February 1999",
    "lgpl-3.0": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "libpng": "libpng License",
    "lppl-1.3c": "The LaTeX Project Public License", "mit": "The MIT License", "mpl-1.1": "MOZILLA PUBLIC LICENSE Version 1.1",
    "mpl-2.0": "the Mozilla Public License, v. 2.0", "ms-pl": "Microsoft Public License", "ms-rl": "Microsoft Reciprocal License",
    "mulan-psl-2.0": "Mulan Permissive Software License, Version 2", "ncsa": "University of Illinois/NCSA Open Source License",
    "odbl-1.0": "Open Database License", "ofl-1.1": "SIL Open Font License Version 1.1", "openssl": "OpenSSL License",
    "osl-3.0": "Open Software License", "php-3.01": "The PHP License, version 3.01", "postgresql": "The PostgreSQL Licence",
    "python-2.0": "Python Software Foundation License", "qpl-1.0": "THE Q PUBLIC LICENSE", "ruby": "Ruby License",
    "sleepycat": "The Sleepycat License", "unlicense": "The Unlicense", "upl-1.0": "The Universal Permissive License",
    "vim": "VIM LICENSE", "wtfpl": "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE", "x11": "X11 License", "zlib": "zlib License",
}


def test_every_plain_title_gets_its_label(spark):
    assert set(PLAIN_TITLES) == {label for label, *_ in licenses.LICENSES}
    cases = [(label, t) for label, title in PLAIN_TITLES.items() for t in (title, title.replace(" ", "\n ") + "\n\nx")]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(cases)], "doc_id long, text string")
    for r in licenses.scan(docs.repartition(8)).collect():
        label, text = cases[r.doc_id]
        by_method = set(r.labels.split(",")) - (set(r.base_labels.split(",")) - {label})
        assert by_method == {label} and r.score == 0.8, (text, r.labels)
        assert ungated(text)[0] == {label}
