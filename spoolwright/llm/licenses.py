"""License scans by ordered signature rules, in DataFrame operations only.

A text's words stand between single spaces; rules are regular expressions over them (license_rules). A rule is tried only where its keyword
stands, on the words from there on, so that all other words cost one look-up. Detections are intervals of words. One that lies within the
interval of another is suppressed if that one comes before it by kind, length and rule number; base phrases are never suppressed. All of
it happens within a document's row: nothing is shuffled.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .decontaminate import words
from .license_rules import WINDOW, Rule, read_rules

BY_KEYWORD = "map<string, array<struct<number: int, label: string, kind: string, rank: int, confidence: double, base: boolean, pattern: string>>>"


def _by_keyword(rules: list[Rule]) -> Column:
    """The rules of each keyword, as a constant."""
    table: dict[str, list] = {}
    for r in rules:
        table.setdefault(r.keyword, []).append({k: v for k, v in r._asdict().items() if k != "keyword"})
    return F.from_json(F.lit(json.dumps(table)), BY_KEYWORD)


def scan(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """doc_id, n_words and detections of every row of docs, by position.

    detections: array of start and size in words, number, label, kind, rank, confidence and base of the rule, text (the words), and kept,
    false for suppressed ones. Null and empty texts have no words. Rows with equal ids or texts have results each; other columns are not
    read. A rule gives one detection a start, its longest by the expression's own order of choices.
    """
    rules = read_rules() if rules is None else rules
    table = _by_keyword(rules)
    keywords = sorted({r.keyword for r in rules})
    ws = F.coalesce(words(F.col("text")), F.array().cast("array<string>"))
    out = docs.select("doc_id", ws.alias("ws"))
    places = F.filter(F.transform("ws", lambda w, i: F.when(w.isin(keywords), i)), lambda i: i.isNotNull())
    out = out.select("doc_id", "ws", places.alias("places"))
    after = lambda i: F.concat(F.array_join(F.slice("ws", i + 1, WINDOW), " "), F.lit(" "))
    tried = F.transform("places", lambda i: F.struct(i.alias("start"), after(i).alias("after"), F.element_at(table, F.get("ws", i)).alias("rules")))
    out = out.select("doc_id", F.size("ws").cast("long").alias("n_words"), tried.alias("tried"))

    def matched(x: Column) -> Column:
        one = lambda r: F.struct(x["start"].alias("start"), r.alias("rule"), F.call_function("regexp_extract", x["after"], r["pattern"], F.lit(0)).alias("text"))
        size = lambda t: F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit("")))
        full = lambda d: F.struct(d["start"].alias("start"), size(d["text"]).alias("size"), *[d["rule"][c].alias(c) for c in ("number", "label", "kind", "rank", "confidence", "base")], F.rtrim(d["text"]).alias("text"))
        return F.transform(F.filter(F.transform(x["rules"], one), lambda d: d["text"] != ""), full)

    out = out.select("doc_id", "n_words", F.transform("tried", matched).alias("found"))

    def before(e: Column, d: Column) -> Column:
        """e holds d's interval and comes first."""
        holds = (e["start"] <= d["start"]) & (e["start"] + e["size"] >= d["start"] + d["size"])
        first = (e["rank"] < d["rank"]) | ((e["rank"] == d["rank"]) & ((e["size"] > d["size"]) | ((e["size"] == d["size"]) & (e["number"] < d["number"]))))
        return holds & first

    def told(here: Column, j: Column) -> Column:
        # places ascend, so what can hold an interval starts at one of the last WINDOW places
        near = F.flatten(F.slice("found", F.greatest(j - (WINDOW - 1), F.lit(0)) + 1, F.least(j, F.lit(WINDOW - 1)) + 1))
        kept = lambda d: d["base"] | ~F.exists(near, lambda e: before(e, d))
        return F.transform(here, lambda d: d.withField("kept", kept(d)))

    return out.select("doc_id", "n_words", F.flatten(F.transform("found", told)).alias("detections"))


def detections(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """One row per detection, suppressed ones included."""
    return scan(docs, rules).select("doc_id", F.inline("detections"))


def licenses(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of every row of docs.

    n_base counts the places of base phrases, first_word and last_word are the least and greatest of their starts. labels are those of all
    detections that are kept, base_labels those of base phrases; both are distinct, sorted and joined by commas, '' for none. score is the
    confidence of the surest detection that is kept, 0 without any.
    """
    kept = F.filter("detections", lambda d: d["kept"])
    base = F.filter("detections", lambda d: d["base"])
    out = scan(docs, rules).select("doc_id", "n_words", kept.alias("kept"), base.alias("base"))
    of = lambda c, field: F.transform(c, lambda d: d[field])
    names = lambda c: F.array_join(F.array_sort(F.array_distinct(of(c, "label"))), ",")
    return out.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(of("base", "start")).cast("long").alias("first_word"), F.array_max(of("base", "start")).cast("long").alias("last_word"),
        names("base").alias("base_labels"), names("kept").alias("labels"), F.coalesce(F.array_max(of("kept", "confidence")), F.lit(0.0)).alias("score"),
    )
