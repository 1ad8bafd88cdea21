"""Source divergence, license scans and vector codes against plain Python."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest

from spoolwright.llm import compression, divergence, licenses, queries
from spoolwright.llm.license_rules import KINDS, WINDOW, read_rules

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_audit(rows, least, top):
    docs = [(r["lang"] or "", r["source"] or "", TERM.findall(lower(r["text"]))) for r in rows]
    n, d = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for lang, source, terms in docs:
        n[lang, source].update(terms)
        d[lang].update(set(terms))
    out = set()
    for lang in d:
        kept = sorted(t for t, c in d[lang].items() if c >= least)
        sources = sorted(s for x, s in n if x == lang)
        share = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c[t] for t in kept) + 2 * len(kept)) for t in kept}  # noqa: B023, E731
        p = {s: share(n[lang, s]) for s in sources}
        q = share(sum((n[lang, s] for s in sources), collections.Counter()))
        gap = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(sum(gap(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(gap(p[s][t], q[t]), t) for t in kept if n[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out |= {(lang, s, part, item, v, i + 1) for i, (v, item) in enumerate(ranked)}
    return out


@pytest.mark.parametrize("options", [{}, {"width": 1 << 3}, {"broadcast_rows": 0}])
def test_audit_equals_plain_counts(spark, edge, nothing, options):
    wanted = plain_audit([r.asDict() for r in edge.collect()], 3, 2)
    got = [tuple(r) for r in divergence.audit(edge, 3, 2, **options).collect()]
    assert len(got) == len(set(got)) and set(got) == wanted and {x[2] for x in got} == {"pair", "term"}
    assert divergence.audit(nothing).count() == 0
    alone = divergence.audit(edge, 1000).collect()
    assert {r.value for r in alone} == {0} and {r.part for r in alone} == {"pair"}


def test_sketch_never_underestimates(spark):
    g = random.Random(3)
    words = [f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyz'[i // 100 % 6]}" for i in range(600)]
    rows = [("en", "s", " ".join(g.choices(words, range(1, 601), k=30))) for _ in range(400)]
    df = spark.createDataFrame(rows, "lang string, source string, text string").repartition(5)
    true = collections.Counter(t for r in rows for t in set(divergence.terms_of(r[2])))
    for width in (1 << 6, 1 << 12):
        sketch = divergence.document_sketch(df, width)
        assert len(sketch) == divergence.DEPTH * width
        estimate = sketch[divergence.cells("en", list(true), width)].min(1)
        assert all(e >= min(255, true[t]) for e, t in zip(estimate, true, strict=True))
    assert np.mean(divergence.possible(sketch, "en", list(true), 20)) < 0.9  # and it discards


def test_audit_passes_terms_on_when_it_holds_many(spark, edge, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 40)
    assert {tuple(r) for r in divergence.audit(edge, 3, 2).collect()} == plain_audit([r.asDict() for r in edge.collect()], 3, 2)


def test_shares_are_exact_beyond_long_products(spark):
    from pyspark.sql import functions as F

    n, total, v = 60_000_000_000_000, 900_000_000_000_007, 12_345_678
    got = spark.range(1).select(divergence.share(F.lit(n).cast("long"), F.lit(total).cast("long"), F.lit(v).cast("long"))).first()[0]
    assert got == 1 + 10**9 * (n + 2) // (total + 2 * v)


def plain_scan(text, rules):
    words = WORD.findall(lower(text))
    found = []
    for i, w in enumerate(words):
        after = " ".join(words[i : i + WINDOW]) + " "
        for r in rules:
            m = re.match(r.pattern, after) if r.keyword == w else None
            if m:
                found.append((i, m[0].count(" "), r))
    kept = []
    for s, n, r in found:
        holds = [x for x in found if x[0] <= s and x[0] + x[1] >= s + n and (x[2].rank, -x[1], x[2].number) < (r.rank, -n, r.number)]
        if r.base or not holds:
            kept.append((s, n, r))
    base = [s for s, _, r in found if r.base]
    names = lambda rs: ",".join(sorted({r.label for r in rs}))
    return (len(words), len(base), min(base, default=None), max(base, default=None), names(r for *_, r in found if r.base), names(r for *_, r in kept), max((r.confidence for *_, r in kept), default=0.0))


LICENSED = [
    "This work is licensed under the GNU General Public License, version 3.", "Released under the MIT License.", "Licensed under CC BY-NC 4.0. CC BY, cc by", "SPDX-License-Identifier: Apache-2.0",
    "See https://www.gnu.org/licenses/old-licenses/gpl-2.0.html and http://opensource.org/licenses/MIT", "Copyright. All rights reserved. GNU\nGeneral -- public; LICENSE", "mit license mit license mit licence",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "apache license " * 300, "licensed under the", "gnu gnu general public license gnu general public",
    "Todos los derechos reservados. tous droits réservés", "cc by cc by cc by", "Dual: GPL v2 or MIT License; either version 2 of the License, or (at your option) any later version.",
]


def test_scan_equals_plain_matching(spark, edge, nothing):
    texts = LICENSED + [r.text for r in edge.select("text").collect()] + ["word " * 20_000 + "mit license", "licensed " * 3000]
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(texts)], "doc_id long, text string, labels string, score int").repartition(3)
    rules = read_rules()
    got = {r.doc_id: tuple(r)[1:] for r in licenses.licenses(df).collect()}
    assert got == {i: plain_scan(t, rules) for i, t in enumerate(texts)}
    assert got[0][5] == "gpl,gpl-3.0" and got[2][5] == "cc-by,cc-by-nc-4.0" and got[8][1] == 300 and got[11][5] == "all-rights"
    assert licenses.licenses(nothing).count() == 0 and licenses.licenses(edge).count() == edge.count()


def test_detections_are_spans_and_suppression_keeps_the_first(spark):
    df = spark.createDataFrame([(1, "It is licensed under the MIT License, (c) 2020")], "doc_id long, text string")
    rows = {(r.start, r.size, r.label, r.kind): (r.kept, r.text) for r in licenses.detections(df).collect()}
    assert rows[2, 5, "mit", "grant"] == (True, "licensed under the mit license") and rows[5, 2, "mit", "name"][0] is False and rows[5, 2, "mit", "mention"][0] is True


def test_rules_are_well_formed():
    rules = read_rules()
    assert len(rules) > 200 and [r.number for r in rules] == list(range(len(rules)))
    assert {r.label for r in rules if r.base} == {"gpl", "apache", "cc-by", "mit"} and {r.kind for r in rules} == set(KINDS)
    assert len({(r.label, r.pattern) for r in rules}) == len(rules)
    for bad in ("x tag", "x nokind a b", "x tag (a|b) c", "x tag a|b"):
        with pytest.raises(ValueError):
            read_rules(bad)


def plain_codes(rows, parts=16, entries=64, rounds=2, scale=256):
    """rows: (vec_id, vector of whole multiples of 1/scale, label), in the order in which codebooks start."""
    v = [[math.floor(scale * x) for x in r[1]] for r in rows]
    w = len(v[0]) // parts
    cut = lambda x, p: x[p * w : (p + 1) * w]
    books = [[cut(x, p) for x in v[:entries]] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            members = collections.defaultdict(list)
            for x in v:
                members[near(cut(x, p), books[p])[1]].append(cut(x, p))
            for k, of in members.items():
                books[p][k] = [sum(c) // len(of) for c in zip(*of, strict=True)]
    best = [[near(cut(x, p), books[p]) for p in range(parts)] for x in v]
    by_label = collections.Counter()
    for r, b in zip(rows, best, strict=True):
        by_label[r[2]] += sum(d for d, _ in b)
    sha = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    return [(r[0], "".join(f"{k:02x}" for _, k in b), sum(d for d, _ in b), by_label[r[2]], sha) for r, b in zip(rows, best, strict=True)]


SCHEMA = "vec_id long, embedding array<double>, label int, code string, error string"


def test_codes_equal_plain_ones(spark):
    g = random.Random(2)
    vector = lambda: [g.choice([0.25, 1.0]) * g.gauss(0, 1) for _ in range(32)]
    rows = [(i, vector(), g.choice([1, 1, 1, 2, None])) for i in range(150)]
    rows += [(200 + i, rows[7][1], 1) for i in range(40)]  # copies of one vector
    bad = [(900, None, 1), (901, [None] * 32, 1), (902, [float("nan")] * 32, 2), (903, [float("inf")] + [0.0] * 31, 2)]
    df = spark.createDataFrame([(*r, "clash", "clash") for r in [*bad, *reversed(rows)]], SCHEMA).repartition(4)
    for size in (200_000, 0):
        coded = compression.encode(df.limit(0).selectExpr("vec_id", "embedding AS v"), {})
        assert coded.columns == ["vec_id", "code", "error"]
        assert sorted(map(tuple, compression.compress(df).collect())) == sorted(plain_codes(rows))
        spilled = spark.createDataFrame([(i, i % 3 or None, i) for i in range(20)], "vec_id long, grp int, error long")
        sums = {r.vec_id: r.group_error for r in compression.with_group_error(spilled, "grp", size).collect()}
        assert sums == {i: sum(j for j in range(20) if j % 3 == i % 3) for i in range(20)}


def test_code_edges(spark):
    df = lambda rows: spark.createDataFrame([(*r, "c", "c") for r in rows], SCHEMA)
    assert compression.compress(df([])).count() == 0
    (one,) = compression.compress(df([(1, [0.5] * 16, None)])).collect()
    assert one.code == "00" * 16 and one.error == 0 and one.group_error == 0
    big = [(1, [1e12] * 16, 1), (2, [-1e12] * 16, 1), (3, [3.0] * 16, 1), (4, [1e12 + 1] * 16, 2)]
    assert sorted(map(tuple, compression.compress(df(big)).collect())) == sorted(plain_codes(big))
    huge = compression.compress(df([(i, [1.5e308 * (-1) ** i, 7.0] + [0.0] * 14, 1) for i in range(70)])).collect()
    assert len(huge) == 70 and {r.error for r in huge} == {0}
    mixed = compression.compress(df([(1, [], 1), (None, [1.0] * 16, 1), (3, [2.0] * 5, 1), (3, [2.0] * 5, 1)])).collect()
    assert len(mixed) == 4 and all(r.error == 0 for r in mixed) and len({r.codebooks_sha256 for r in mixed}) == 3
    with pytest.raises(ValueError):
        compression.train(df([]).selectExpr("vec_id", "embedding AS v"), entries=257)


def test_annulus_finds_the_nearest_with_fewer_distances():
    g = np.random.default_rng(5)
    for x, e in ((g.integers(-300, 300, (500, 4)), g.integers(-300, 300, (64, 4))), (g.integers(-3, 3, (500, 2)), g.integers(-3, 3, (64, 2))), (g.integers(0, 9, (20, 3)), np.zeros((5, 3), np.int64)), (np.zeros((3, 0), np.int64), np.zeros((4, 0), np.int64))):
        far = ((x[:, None] - e) ** 2).sum(2)
        pick, best, _ = compression.nearest(x, e)
        assert (pick == far.argmin(1)).all() and (best == far.min(1)).all()
    e = (g.integers(-99, 99, (256, 4)) * np.linspace(1, 60, 256)[:, None]).astype(np.int64)
    x = e[g.integers(0, 256, 2000)] + g.integers(-5, 5, (2000, 4))
    assert compression.nearest(x, e)[2] < 0.2 * len(x) * len(e)


def test_codes_decode_near_their_vectors(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    v = compression.usable(rows).selectExpr("vec_id", "transform(embedding, x -> cast(x AS double)) AS v")
    books = compression.train(v)
    vectors = {r.vec_id: r.v for r in v.collect()}
    for r in compression.encode(v, books).limit(20).collect():
        gap = compression.SCALE * (compression.decode(bytes(r.code), books[64]) - vectors[r.vec_id])
        assert (np.abs(np.abs(gap).max()) ** 2 <= 4 * (r.error + 64)).all()


def test_new_queries_return_their_contract(spark):
    sf = "/root/testdata/sf0.001"
    assert queries.op11_divergence(spark, sf).dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")]
    assert queries.op12_licenses(spark, sf).dtypes == [("doc_id", "bigint"), ("n_words", "bigint"), ("n_base", "bigint"), ("first_word", "bigint"), ("last_word", "bigint"), ("base_labels", "string"), ("labels", "string"), ("score", "double")]
    assert queries.op13_compression(spark, sf).dtypes == [("vec_id", "bigint"), ("code", "string"), ("error", "bigint"), ("label_error", "bigint"), ("codebooks_sha256", "string")]


def test_workers_let_go_of_what_other_operators_keep(monkeypatch):
    from spoolwright.llm import _shared

    monkeypatch.setattr(_shared, "_owner", [""])
    monkeypatch.setattr(_shared, "_letting_go", {})
    mine, other = {1: 1}, {2: 2}
    _shared.working_for("mine", mine.clear)
    _shared.working_for("mine", mine.clear)
    assert mine
    _shared.working_for("other", other.clear)
    assert other and not mine
    _shared.working_for("mine", mine.clear)
    assert not other
