"""License scans by ordered signature rules, in DataFrame functions only.

A rule is a label, a regular expression, the keywords that must all occur before the
expression is tried, a rank and a confidence. The rules come from the names of each license and a list
of templates, some hundreds in all. Places found by the rules compete: a place within the
place of a rule of the same or a better rank is dropped, as is the worse of two rules at one
place. One pass cuts the text to its distinct stretches of words that may follow each other in a
rule; a place lies within one stretch, so the rules are tried on each alone.

Beside that stand the base phrases: places where a phrase's words stand consecutively. Their
labels are always reported.

Rows: a null text is an empty one: no words, no labels, score 0. Repeated rows and null ids
are scanned each. An empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.columns import let

#: The base phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by",
        "mit license": "mit"}
#: label: (names, identifiers, address parts). A name's words are its keywords.
LICENSES = {
    "gpl": (["gnu general public license", "gnu gpl", "gpl license"], ["gpl-2.0", "gpl-3.0"],
            ["gnu.org/licenses/gpl"]),
    "lgpl": (["gnu lesser general public license", "gnu library general public license",
              "lgpl license"], ["lgpl-2.1", "lgpl-3.0"], ["gnu.org/licenses/lgpl"]),
    "agpl": (["gnu affero general public license", "affero general public license",
              "agpl license"], ["agpl-3.0"], ["gnu.org/licenses/agpl"]),
    "gfdl": (["gnu free documentation license", "gfdl license"], ["gfdl-1.3"],
             ["gnu.org/licenses/fdl"]),
    "apache": (["apache license", "apache software license"], ["apache-2.0", "apache-1.1"],
               ["apache.org/licenses"]),
    "mit": (["mit license", "expat license", "x11 license"], ["mit"],
            ["opensource.org/licenses/mit"]),
    "bsd": (["bsd license", "bsd 2 clause license", "bsd 3 clause license",
             "simplified bsd license"], ["bsd-2-clause", "bsd-3-clause"],
            ["opensource.org/licenses/bsd"]),
    "mpl": (["mozilla public license", "mpl license"], ["mpl-2.0", "mpl-1.1"], ["mozilla.org/mpl"]),
    "epl": (["eclipse public license", "epl license"], ["epl-2.0", "epl-1.0"],
            ["eclipse.org/legal/epl"]),
    "cddl": (["common development and distribution license", "cddl license"], ["cddl-1.0"],
             ["opensource.org/licenses/cddl"]),
    "eupl": (["european union public license", "eupl license"], ["eupl-1.2"],
             ["joinup.ec.europa.eu/eupl"]),
    "artistic": (["artistic license", "perl artistic license"], ["artistic-2.0"],
                 ["opensource.org/licenses/artistic"]),
    "isc": (["isc license"], ["isc"], ["opensource.org/licenses/isc"]),
    "boost": (["boost software license"], ["bsl-1.0"], ["boost.org/license"]),
    "zlib": (["zlib license", "zlib libpng license"], ["zlib"], ["zlib.net/zlib_license"]),
    "unlicense": (["unlicense"], ["unlicense"], ["unlicense.org"]),
    "wtfpl": (["wtfpl license"], ["wtfpl"], ["wtfpl.net"]),
    "ofl": (["sil open font license", "open font license"], ["ofl-1.1"], ["scripts.sil.org/ofl"]),
    "odbl": (["open database license"], ["odbl-1.0"], ["opendatacommons.org/licenses/odbl"]),
    "cc0": (["cc0 public domain dedication", "cc0 license", "creative commons zero"], ["cc0-1.0"],
            ["creativecommons.org/publicdomain/zero"]),
    "cc-by": (["creative commons attribution license", "creative commons attribution",
               "cc by license"], ["cc-by-4.0", "cc-by-3.0"], ["creativecommons.org/licenses/by/"]),
    "cc-by-sa": (["creative commons attribution sharealike",
                  "creative commons attribution share alike", "cc by sa"],
                 ["cc-by-sa-4.0", "cc-by-sa-3.0"], ["creativecommons.org/licenses/by-sa/"]),
    "cc-by-nc": (["creative commons attribution noncommercial", "cc by nc"], ["cc-by-nc-4.0"],
                 ["creativecommons.org/licenses/by-nc/"]),
    "cc-by-nd": (["creative commons attribution noderivatives", "cc by nd"], ["cc-by-nd-4.0"],
                 ["creativecommons.org/licenses/by-nd/"]),
    "postgresql": (["postgresql license"], ["postgresql"], ["postgresql.org/about/licence"]),
    "python": (["python software foundation license", "psf license"], ["psf-2.0"],
               ["docs.python.org/license"]),
}
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: (kind, expression around {x}, rank, confidence); a better rank is a smaller number.
TEMPLATES = [
    ("tag", "spdx" + GAP + "license" + GAP + "identifier" + GAP + "{x}", 1, 1.0),
    ("name", "(?:licensed|released|distributed|available|published)" + GAP
     + "under" + GAP + "(?:the" + GAP + ")?(?:terms" + GAP + "of" + GAP + "the" + GAP
     + ")?{x}(?:" + GAP + "(?:v|version)" + GAP + r"?\d+(?:\.\d+)?)?", 2, 0.95),
    ("name", "{x}" + GAP + "(?:v|version)" + GAP + r"?\d+(?:\.\d+)?", 3, 0.9),
    ("name", "(?:terms|conditions)" + GAP + "of" + GAP + "(?:the" + GAP + ")?{x}", 3, 0.9),
    ("name", "(?:see|copy" + GAP + "of)" + GAP + "(?:the" + GAP + ")?{x}", 4, 0.8),
    ("name", "{x}", 5, 0.7),
    ("address", "{x}", 4, 0.85),
]
#: One of these occurs in every text that a rule or a base phrase can match.
GATES = ["licen", "spdx", "gnu", "cc", "creative", "wtfpl", ".org/", ".eu/"]
#: A character of a word, lower-cased; ranges are tested faster than the complement of a gap.
WORD = r"[0-9a-z\x80-\x{10FFFF}]"
CASED_WORDS = r"[0-9A-Za-z\x80-\x{10FFFF}]+"
NUMBER = "[0-9]+"


def quoted(text: str) -> str:
    return "".join(c if c.isalnum() or c == "_" else f"\\{c}" for c in text)


def rules() -> list[dict]:
    """Rules in their order: label, keywords, expression, rank, confidence."""
    out = []
    for label, (names, tags, addresses) in LICENSES.items():
        for kind, template, rank, sure in TEMPLATES:
            for x in {"name": names, "tag": tags, "address": addresses}[kind]:
                body = GAP.join(x.split()) if kind == "name" else quoted(x)
                rx = "(?<![^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F])" + template.replace("{x}", body)
                rx += "" if kind == "address" else "(?![^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F])"
                keys = {"name": x.split(), "tag": ["spdx", x], "address": [x]}[kind]
                out.append({"n": len(out), "label": label, "keys": keys, "rx": rx, "rank": rank,
                            "sure": sure})
    return out


def follows() -> dict[str, set[str]]:
    """The words of all rules, and after each those that may follow it within a rule, or more.

    A fixed phrase before a name counts as one word: else "license" in it would join the end of
    one name to the start of the next, and stretches would grow with a list of licenses.
    """
    out: dict[str, set[str]] = {}

    def meet(left, right):
        for a in left:
            out.setdefault(a, set()).update(right)

    for names, tags, addresses in LICENSES.values():
        for kind, template, _, _ in TEMPLATES:
            before, after = ([NUMBER if w == "\\d" else w for w in re.findall(r"[a-z]+|\\d", part)]
                             for part in template.replace(GAP, " ").split("{x}"))
            if "(" not in template:
                before = [GAP.join(before)] if before else []
            meet(before, before)
            meet(after, after)
            for x in {"name": names, "tag": tags, "address": addresses}[kind]:
                words = re.split(GAP, x.strip("/"))
                meet(before, words[:1])
                for a, b in zip(words, words[1:]):
                    meet([a], [b])
                meet(words[-1:], after)
    return out


def any_of(ends: dict[str, str]) -> str:
    """An expression for one of the words with what must come after it, tried by their first letter."""
    by_letter: dict[str, list[str]] = {}
    for word, end in ends.items():
        first, rest = (NUMBER, "") if word == NUMBER else (word[0], word[1:])
        by_letter.setdefault(first, []).append(rest + end)
    return "(?:" + "|".join(f"{a}(?:{'|'.join(b)})" for a, b in by_letter.items()) + ")"


def stretches(low: Column) -> Column:
    """The distinct longest stretches of words that may follow each other, where a rule may match.

    They begin and end with whole words, and keep the stroke that ends an address, so a rule
    finds in them what it finds in the text.
    """
    after = follows()
    step = any_of({w: f"{GAP}+(?={any_of(dict.fromkeys(sorted(f), ''))})"
                   for w, f in after.items() if f})
    rx = f"(?<!{WORD}){step}*+{any_of(dict.fromkeys(after, ''))}{WORD}*+/?"
    found = F.array_distinct(F.regexp_extract_all(low, F.lit(rx), F.lit(0)))
    return F.filter(found, gated)


def gated(low: Column) -> Column:
    gate = F.lit(False)
    for g in GATES:
        gate = gate | F.contains(low, F.lit(g))
    return gate


def places(text: Column, rx: Column) -> Column:
    """Start and end of every match: the text between matches gives the lengths before each."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<lo:int,hi:int>>").alias("out"))

    def step(s, p):
        lo = s["at"] + F.length(p["gap"])
        hi = lo + F.length(p["hit"])
        return F.struct(hi.alias("at"), F.array_append(
            s["out"], F.struct(lo.alias("lo"), hi.alias("hi"))).alias("out"))

    return let(F.regexp_extract_all(text, rx, F.lit(0)), lambda hits: F.when(
        F.size(hits) > 0, F.aggregate(F.arrays_zip(
            F.slice(F.split(text, rx, -1), 1, F.size(hits)).alias("gap"), hits.alias("hit")),
            start, step, lambda s: s["out"])))


def spots(pieces: Column) -> Column:
    """Every word's number and the base phrase that starts there, null if none."""
    def phrases(words):
        def phrase(i):
            found = F.lit(None).cast("string")
            for p in BASE:
                test = F.lit(True)
                for k, w in enumerate(p.split()):
                    test = test & (F.get(words, i + k) == w)
                found = F.when(test, p).otherwise(found)
            return F.struct(i.alias("at"), found.alias("phrase"))
        return F.transform(F.sequence(F.lit(0), F.size(words)), phrase)

    return let(F.filter(pieces, lambda w: w != ""), phrases)


def detections(table: Column, low: Column) -> Column:
    """Places of the rules whose keywords all occur."""
    live = F.filter(table, lambda r: F.forall(r["keys"], lambda k: F.contains(low, k)))
    found = F.transform(live, lambda r: F.transform(places(low, r["rx"]), lambda p: F.struct(
        p["lo"].alias("lo"), p["hi"].alias("hi"), r["rank"].alias("rank"), r["n"].alias("n"),
        r["label"].alias("label"), r["sure"].alias("sure"))))
    return F.flatten(F.filter(found, lambda x: x.isNotNull()))


def undefeated(seen: Column) -> Column:
    """The places that no other place of the same or a better rank covers."""
    def beaten(a):
        def beats(b):
            inside = (b["lo"] <= a["lo"]) & (b["hi"] >= a["hi"])
            same = (b["lo"] == a["lo"]) & (b["hi"] == a["hi"])
            better = (b["rank"] < a["rank"]) | ((b["rank"] == a["rank"]) & (b["n"] < a["n"]))
            return inside & F.when(same, better).otherwise(b["rank"] <= a["rank"])
        return F.exists(seen, beats)

    return F.filter(seen, lambda a: ~beaten(a))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Words, base places and labels, and the labels and confidence of the rules."""
    base_labels = F.create_map(*[F.lit(x) for pair in BASE.items() for x in pair])
    shape = "array<struct<n:int,label:string,keys:array<string>,rx:string,rank:int,sure:double>>"
    table = F.from_json(F.lit(json.dumps(rules())), shape)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                    (F.size(F.split(text, CASED_WORDS, -1)) - 1).cast("bigint").alias("n_words"),
                    F.lower(text).alias("low"))
    d = d.withColumn("low", F.when(gated(F.col("low")), F.col("low")).otherwise(""))
    table_of = F.filter(let(F.split("low", GAP, -1), spots), lambda x: x["phrase"].isNotNull())
    held = F.flatten(F.transform(stretches(F.col("low")), lambda part: let(
        detections(table, part), undefeated)))
    d = d.select("doc_id", "n_words", F.when(F.col("low") != "", table_of).alias("spots"),
                 F.when(F.col("low") != "", held).alias("held"))
    none = F.array().cast("array<string>")
    base = F.coalesce(F.array_sort(F.array_distinct(F.transform(
        "spots", lambda x: F.element_at(base_labels, x["phrase"])))), none)
    found = F.coalesce(F.col("held")["label"], none)
    sure = F.coalesce(F.array_max(F.col("held")["sure"]), F.lit(0.0))
    return d.select(
        "doc_id", "n_words", F.coalesce(F.size("spots"), F.lit(0)).cast("bigint").alias("n_base"),
        F.array_min(F.col("spots")["at"]).cast("bigint").alias("first_word"),
        F.array_max(F.col("spots")["at"]).cast("bigint").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, found))), ",").alias("labels"),
        F.greatest(sure, F.when(F.size(base) > 0, 0.6).otherwise(0.0)).alias("score"))
