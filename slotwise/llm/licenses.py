"""License scans with ordered signature rules, in built-in column functions.

Rules are regular expressions made from a list of licenses and the forms in which texts name them. A document first
passes one cheap test for any keyword; then only rules whose own keyword it holds are run. A keyword is (part of) one word
that every match of its rule holds, so the tests lose nothing; names without a word in common are rows of their own. Names
may be wrapped between words. The matches are intervals.
In order of start, an interval that lies inside another one of the same or a higher priority is suppressed; the labels
that survive and the weight of the surest one are the result. Beside the rules, base phrases are counted in words.

Null and empty texts have no words and no labels. Rows with equal texts get equal results, each its own row. Extra columns
are left out. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import chosen

# The words of a text, in which A-Z count as a-z, and the base phrases with their labels.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Label, a pattern of its names, its SPDX id, and the part of one word without which no rule of the name can match.
LICENSES = [
    ("0bsd", r"zero[- ]clause bsd", "0BSD", "bsd"),
    ("afl-3.0", r"academic free", "AFL-3.0", "academic"),
    ("agpl-3.0", r"(?:gnu )?affero general public", "AGPL-3.0", "affero"),
    ("apache-1.1", r"apache(?: software)? (?:license,? )?(?:version |v)?1\.1", "Apache-1.1", "apache"),
    ("apache-2.0", r"apache(?: license,?)? (?:version |v)?2(?:\.0)?", "Apache-2.0", "apache"),
    ("artistic-1.0", r"artistic(?: license)? 1\.0", "Artistic-1.0", "artistic"),
    ("artistic-2.0", r"artistic(?: license)? 2\.0", "Artistic-2.0", "artistic"),
    ("bsd-2-clause", r"(?:simplified bsd|bsd[- ]2[- ]clause|2[- ]clause bsd)", "BSD-2-Clause", "bsd"),
    ("bsd-3-clause", r"(?:new bsd|revised bsd|bsd[- ]3[- ]clause|3[- ]clause bsd)", "BSD-3-Clause", "bsd"),
    ("bsd-4-clause", r"(?:original bsd|bsd[- ]4[- ]clause|4[- ]clause bsd)", "BSD-4-Clause", "bsd"),
    ("bsl-1.0", r"boost software", "BSL-1.0", "boost"),
    ("cc0-1.0", r"cc0(?: 1\.0)?", "CC0-1.0", "cc0"),
    ("cc0-1.0", r"creative commons zero", "CC0-1.0", "commons"),
    ("cc-by-3.0", r"cc[- ]by[- ]3\.0", "CC-BY-3.0", "cc"),
    ("cc-by-3.0", r"creative commons attribution[- ]3\.0", "CC-BY-3.0", "commons"),
    ("cc-by-4.0", r"cc[- ]by[- ]4\.0", "CC-BY-4.0", "cc"),
    ("cc-by-4.0", r"creative commons attribution[- ]4\.0", "CC-BY-4.0", "commons"),
    ("cc-by-sa-3.0", r"cc[- ]by[- ]sa[- ]3\.0", "CC-BY-SA-3.0", "cc"),
    ("cc-by-sa-3.0", r"creative commons attribution[- ]sharealike[- ]3\.0", "CC-BY-SA-3.0", "commons"),
    ("cc-by-sa-4.0", r"cc[- ]by[- ]sa[- ]4\.0", "CC-BY-SA-4.0", "cc"),
    ("cc-by-sa-4.0", r"creative commons attribution[- ]sharealike[- ]4\.0", "CC-BY-SA-4.0", "commons"),
    ("cc-by-nc-4.0", r"cc[- ]by[- ]nc[- ]4\.0", "CC-BY-NC-4.0", "cc"),
    ("cc-by-nc-4.0", r"creative commons attribution[- ]noncommercial[- ]4\.0", "CC-BY-NC-4.0", "commons"),
    ("cc-by-nd-4.0", r"cc[- ]by[- ]nd[- ]4\.0", "CC-BY-ND-4.0", "cc"),
    ("cc-by-nd-4.0", r"creative commons attribution[- ]noderivatives[- ]4\.0", "CC-BY-ND-4.0", "commons"),
    ("cc-by-nc-sa-4.0", r"cc[- ]by[- ]nc[- ]sa[- ]4\.0", "CC-BY-NC-SA-4.0", "cc"),
    ("cc-by-nc-nd-4.0", r"cc[- ]by[- ]nc[- ]nd[- ]4\.0", "CC-BY-NC-ND-4.0", "cc"),
    ("cddl-1.0", r"common development and distribution", "CDDL-1.0", "distribution"),
    ("cecill-2.1", r"cecill(?:[- ]2\.1)?", "CECILL-2.1", "cecill"),
    ("cpl-1.0", r"common public license(?: 1\.0)?", "CPL-1.0", "common"),
    ("curl", r"curl license", "curl", "curl"),
    ("epl-1.0", r"eclipse public license[, -]+(?:version |v)?1\.0", "EPL-1.0", "eclipse"),
    ("epl-2.0", r"eclipse public license[, -]+(?:version |v)?2\.0", "EPL-2.0", "eclipse"),
    ("eupl-1.2", r"european union public", "EUPL-1.2", "european"),
    ("gfdl-1.3", r"gnu free documentation", "GFDL-1.3", "documentation"),
    ("gpl-1.0", r"(?:gnu )?general public license,? (?:version |v)1", "GPL-1.0", "general"),
    ("gpl-2.0", r"(?:gnu )?general public license,? (?:version |v)2", "GPL-2.0", "general"),
    ("gpl-3.0", r"(?:gnu )?general public license,? (?:version |v)3", "GPL-3.0", "general"),
    ("isc", r"isc license", "ISC", "isc"),
    ("lgpl-2.1", r"(?:gnu )?(?:lesser|library) general public license,? (?:version |v)2(?:\.1)?", "LGPL-2.1", "general"),
    ("lgpl-3.0", r"(?:gnu )?lesser general public license,? (?:version |v)3", "LGPL-3.0", "general"),
    ("libpng", r"libpng license", "Libpng", "libpng"),
    ("lppl-1.3c", r"latex project public", "LPPL-1.3c", "latex"),
    ("mit", r"mit(?: license)?", "MIT", "mit"),
    ("mit", r"expat(?: license)?", "MIT", "expat"),
    ("mpl-1.1", r"mozilla public license,? (?:version |v)?1\.1", "MPL-1.1", "mozilla"),
    ("mpl-2.0", r"mozilla public license,? (?:version |v)?2(?:\.0)?", "MPL-2.0", "mozilla"),
    ("ms-pl", r"microsoft public", "MS-PL", "microsoft"),
    ("ms-rl", r"microsoft reciprocal", "MS-RL", "reciprocal"),
    ("mulan-psl-2.0", r"mulan permissive software", "MulanPSL-2.0", "mulan"),
    ("ncsa", r"ncsa(?: open source)?", "NCSA", "ncsa"),
    ("ncsa", r"university of illinois(?: open source)?", "NCSA", "illinois"),
    ("odbl-1.0", r"open (?:data commons open )?database", "ODbL-1.0", "database"),
    ("ofl-1.1", r"sil open font", "OFL-1.1", "font"),
    ("openssl", r"openssl license", "OpenSSL", "openssl"),
    ("osl-3.0", r"open software", "OSL-3.0", "software"),
    ("php-3.01", r"php license", "PHP-3.01", "php"),
    ("postgresql", r"postgresql license", "PostgreSQL", "postgresql"),
    ("python-2.0", r"python(?: software foundation)? license", "Python-2.0", "python"),
    ("qpl-1.0", r"q public", "QPL-1.0", "public"),
    ("ruby", r"ruby license", "Ruby", "ruby"),
    ("sleepycat", r"sleepycat", "Sleepycat", "sleepycat"),
    ("unlicense", r"(?:the )?unlicense", "Unlicense", "unlicen"),
    ("upl-1.0", r"universal permissive", "UPL-1.0", "permissive"),
    ("vim", r"vim license", "Vim", "vim"),
    ("wtfpl", r"wtfpl", "WTFPL", "wtfpl"),
    ("wtfpl", r"do what the fuck you want to public", "WTFPL", "fuck"),
    ("x11", r"x11 license", "X11", "x11"),
    ("zlib", r"zlib license", "Zlib", "zlib"),
]
# Names that hold the word "license" as they stand, and other titles that the form of a name before "license" does not take:
# label, pattern, keyword. A title takes in its version, so that the title of another license inside it is suppressed.
WHOLE_NAMES = {
    "curl", "epl-1.0", "epl-2.0", "gpl-1.0", "gpl-2.0", "gpl-3.0", "isc", "lgpl-2.1", "lgpl-3.0", "libpng", "mpl-1.1", "mpl-2.0",
    "openssl", "php-3.01", "postgresql", "python-2.0", "ruby", "unlicense", "vim", "x11", "zlib",
}
TITLES = [
    *((label, name, keyword) for label, name, _, keyword in LICENSES if label in WHOLE_NAMES),
    ("0bsd", r"bsd zero[- ]clause license", "bsd"),
    ("agpl-3.0", r"(?:gnu )?affero general public license(?:,? (?:version |v)[0-9](?:\.[0-9])?)?", "affero"),
    ("apache-1.1", r"apache(?: software)? license,? (?:version |v)?1\.1", "apache"),
    ("apache-2.0", r"apache(?: software)? license,? (?:version |v)?2(?:\.0)?", "apache"),
    ("artistic-1.0", r"artistic license,? (?:version |v)?1\.0", "artistic"),
    ("artistic-2.0", r"artistic license,? (?:version |v)?2\.0", "artistic"),
    ("cc0-1.0", r"cc0 1\.0 universal", "cc0"),
    ("cc0-1.0", r"creative commons zero (?:version |v)?1\.0", "commons"),
    ("cc-by-3.0", r"creative commons attribution[- ]3\.0", "commons"),
    ("cc-by-4.0", r"creative commons attribution[- ]4\.0", "commons"),
    ("cc-by-sa-3.0", r"creative commons attribution[- ]sharealike[- ]3\.0", "commons"),
    ("cc-by-sa-4.0", r"creative commons attribution[- ]sharealike[- ]4\.0", "commons"),
    ("cc-by-nc-4.0", r"creative commons attribution[- ]noncommercial[- ]4\.0", "commons"),
    ("cc-by-nd-4.0", r"creative commons attribution[- ]noderivatives[- ]4\.0", "commons"),
    ("cc-by-nc-sa-4.0", r"creative commons attribution[- ]noncommercial[- ]sharealike[- ]4\.0", "commons"),
    ("cc-by-nc-nd-4.0", r"creative commons attribution[- ]noncommercial[- ]noderivatives[- ]4\.0", "commons"),
    ("cecill-2.1", r"cecill free software license", "cecill"),
    ("cpl-1.0", r"common public license(?:,? (?:version |v)?1\.0)?", "common"),
]
# Priority, weight, and the text around a name or an SPDX id, of each form in which texts state a license.
FORMS = [
    (3, 1.0, r"\bspdx-license-identifier:\s*{id}\b", "spdx"),
    (2, 0.95, r"\b(?:licen[sc]ed|released|distributed|published|available)\s+under\s+(?:the\s+terms\s+of\s+)?(?:the\s+)?{name}\b", None),
    (2, 0.9, r"\b(?:licen[sc]e|terms)\s*[:=]\s*(?:the\s+)?{name}\b", None),
    (1, 0.8, r"\b{name}(?:\s+public)?\s+licen[sc]e\b", None),
    (0, 0.6, r"\blicen[sc]e\s*[:=]?\s*\(?{id}\b", "licen"),
]
TITLE_FORM = (1, 0.8, r"\b{name}\b")
# No rule matches a text in which this finds nothing: each form needs one of these strings.
NAMES_A_LICENSE = r"(?i)licen[sc]e|creative\s+commons|cc0\s|spdx-|\sunder\s|terms\s*[:=]|\bunder\s"
LEVELS = 4


def spaced(name: str) -> str:
    """A pattern of a name as regular expression: any white space between words, both spellings, and versions as "v. 2"."""
    name = name.replace("license", "licen[sc]e").replace("(?:version |v)", r"(?:version\s+|v\.?\s*)")
    return name.replace("[- ]", r"(?:-|\s+)").replace("[, -]", r"[,\s-]").replace(" ", r"\s+")


def rules() -> list[dict]:
    """Every form of every license, in order of the list, then titles; forms of an SPDX id once a license."""
    out, seen = [], set()

    def add(label: str, keyword: str, priority: int, weight: float, regex: str) -> None:
        out.append({"label": label, "keyword": keyword, "priority": priority, "weight": weight, "regex": "(?i)" + regex})

    for label, name, spdx, keyword in LICENSES:
        for priority, weight, form, needs in FORMS:
            if needs and label in seen:
                continue
            quoted = spdx.replace(".", r"\.").replace("+", r"\+")
            regex = form.replace("{name}", f"(?:{spaced(name)})").replace("{id}", quoted)
            add(label, needs or keyword, priority, weight, regex)
        seen.add(label)
    priority, weight, form = TITLE_FORM
    for label, title, keyword in TITLES:
        add(label, keyword, priority, weight, form.replace("{name}", f"(?:{spaced(title)})"))
    return out


def _intervals(text: Column, rule: Column) -> Column:
    """Start and end of each match of a rule: lengths of what stands between matches and of the matches, summed up."""
    found = F.regexp_extract_all(text, rule["regex"], F.lit(0))
    lengths = F.zip_with(
        F.slice(F.split(text, rule["regex"]), F.lit(1), F.size(found)), found,
        lambda gap, match: F.struct(F.length(gap).alias("gap"), F.length(match).alias("match")),
    )
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        span = F.struct(start.alias("start"), (start + x["match"]).alias("end"))
        return F.struct((start + x["match"]).alias("at"), F.array_append(acc["spans"], span).alias("spans"))

    spans = F.aggregate(lengths, begin, add, lambda acc: acc["spans"])
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), (-s["end"]).alias("minus_end"), (-rule["priority"]).alias("minus_priority"),
        rule["label"].alias("label"), rule["weight"].alias("weight"),
    ))


def detections(text: Column) -> Column:
    """All matches of the rules whose keyword the text holds, in order of start; longer and higher ones first."""
    table = F.array(*(
        F.struct(*(F.lit(r[k]).alias(k) for k in ("label", "keyword", "priority", "weight", "regex"))) for r in rules()
    ))
    lower = F.lower(text)
    wanted = F.filter(table, lambda r: F.contains(lower, r["keyword"]))
    return F.array_sort(F.flatten(F.transform(wanted, lambda r: _intervals(text, r))))


def surviving(found: Column) -> Column:
    """Labels and best weight of the detections that no other of their priority or a higher one contains."""
    begin = F.struct(
        F.array(*[F.lit(-1)] * LEVELS).alias("ends"), F.array().cast("array<string>").alias("labels"),
        F.lit(0.0).alias("best"),
    )

    def take(acc: Column, d: Column) -> Column:
        end, priority = -d["minus_end"], -d["minus_priority"]
        # Everything seen so far starts no later, so it contains this one if it ends no earlier.
        inside = F.array_max(F.slice(acc["ends"], priority + 1, F.lit(LEVELS))) >= end
        return F.when(inside, acc).otherwise(F.struct(
            F.transform(acc["ends"], lambda e, p: F.when(p == priority, F.greatest(e, end)).otherwise(e)).alias("ends"),
            F.array_union(acc["labels"], F.array(d["label"])).alias("labels"),
            F.greatest(acc["best"], d["weight"]).alias("best"),
        ))

    return F.aggregate(found, begin, take, lambda acc: F.struct(acc["labels"].alias("labels"), acc["best"].alias("best")))


def base_places(text: Column) -> Column:
    """Start (in words) and label of each place where a base phrase's words stand one after the other."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = F.regexp_extract_all(F.translate(text, upper, lower), F.lit(WORD), F.lit(0))

    def ending_at(word: Column, i: Column, of: Column) -> Column:
        cases = []
        for phrase, label in PHRASES.items():
            parts = phrase.split(" ")
            fits = word == parts[-1]
            for back, part in enumerate(reversed(parts[:-1]), 1):
                fits = fits & (F.get(of, i - back) == part)
            cases.append(F.when(fits, F.struct((i - len(parts) + 1).alias("start"), F.lit(label).alias("label"))))
        return F.filter(F.array(*cases), lambda c: c.isNotNull())

    last_words = sorted({p.split(" ")[-1] for p in PHRASES})
    none = F.array().cast("array<struct<start:int,label:string>>")
    placed = F.transform(words, lambda w, i: F.when(w.isin(*last_words), ending_at(w, i, words)).otherwise(none))
    return F.flatten(F.filter(placed, lambda p: F.size(p) > 0))


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: words, places of base phrases and their labels, labels of all detections, and a score from 0 to 1."""
    rows = chosen(docs, key=key, text=F.coalesce(docs[f"`{text}`"], F.lit("")))
    gate = F.rlike("text", F.lit(NAMES_A_LICENSE))
    counted = rows.select(
        "key", F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_words"),
        F.when(F.rlike("text", F.lit("(?i)license")), base_places(F.col("text"))).alias("base"),
        F.when(gate, surviving(detections(F.col("text")))).alias("found"),
    )
    starts = F.transform("base", lambda p: p["start"])
    no_labels = F.array().cast("array<string>")
    base_labels = F.coalesce(F.array_distinct(F.transform("base", lambda p: p["label"])), no_labels)
    labels = F.array_union(base_labels, F.coalesce("found.labels", no_labels))
    joined = lambda x: F.array_join(F.array_sort(x), ",")
    return counted.select(
        F.col("key").alias(key), "n_words", F.coalesce(F.size("base"), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        joined(base_labels).alias("base_labels"), joined(labels).alias("labels"),
        # A base phrase alone is a mention.
        F.greatest(F.coalesce("found.best", F.lit(0.0)), F.when(F.size(base_labels) > 0, 0.5).otherwise(0.0)).alias("score"),
    )
