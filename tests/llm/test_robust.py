"""Nulls, repeated and large ids, very long texts and clashing columns, in every operator and stage."""

from __future__ import annotations

import pytest
from oracle import same
from test_llm import PASSAGE, by_text, contaminated, one_table, personal, simple_print

from cytospark.llm import decontaminate, licenses, lines, mixing, pii, simhash, toxicity

BIG = (1 << 62) + 5
MARKED = "released permission @ 10.1.2.3 +1 "
LONG = MARKED + " ".join(f"w{i % 997}" for i in range(20_000))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `page.views` long, __hits string, __p_toxic string, __severity string, __kept string, copies string, c1 string, __fp long"


@pytest.fixture(scope="module")
def rows():
    """1,000 rows without id, some of equal texts; repeated ids with different texts; ids over 2^62."""
    texts = [(None, f"null {i // 2} text with words {i // 2} of its own {i // 2} kind", "a") for i in range(1000)]
    texts += [(1, "first text of this id entirely different words", "b"), (1, "second story under the same number but not alike", "b"), (2, "second story under the same number but not alike", "b")]
    texts += [(BIG, f"large {PASSAGE}", None), (BIG + 1, LONG, None), (BIG + 2, None, "c"), (BIG + 3, "", "c"), (BIG + 4, f"large {PASSAGE}", None)]
    return texts


@pytest.fixture(scope="module")
def odd(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), 1, "h", "p", "s", "k", "c", "c1", 7) for i, t, s in rows], SCHEMA)


def others(df):
    return [c for c in df.columns if c != "copies"]


def test_columns_stay(spark, odd):
    """All columns come through every stage as they were."""
    labels = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    for out in (toxicity.remove_toxic(odd, labels), lines.drop_lines(odd), simhash.keep_one(odd), decontaminate.remove_contaminated(odd, bench)):
        assert out.columns == odd.columns
        r = out.where("doc_id IS NULL").first().asDict()
        assert (r["page.views"], r["__hits"], r["__p_toxic"], r["__severity"], r["__kept"], r["copies"], r["c1"], r["__fp"]) == (1, "h", "p", "s", "k", "c", "c1", 7)
    out = mixing.copies(odd)
    assert out.columns == [*others(odd), "copies"] and out.where("copies NOT IN (1, 2)").isEmpty()
    assert out.first()["page.views"] == 1


def test_nothing_is_lost(spark, odd, rows):
    labels = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.remove_toxic(odd, labels).count() == len(rows)
    bench = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    bad = {i for i, *_, c in contaminated([r[:2] for r in rows if r[0]], [(1, PASSAGE)]) if c}
    assert bad == {BIG, BIG + 4}
    assert by_text(r[:2] for r in decontaminate.remove_contaminated(odd, bench).select("doc_id", "text").collect()) == by_text(r[:2] for r in rows if r[0] not in bad)


def test_near_duplicates(spark, odd, rows):
    prints = {t: simple_print(t) for _, t, _ in rows}
    group = {t: min((x for x in prints.values() if (x ^ p).bit_count() <= 4)) for t, p in prints.items()}
    changed = True
    while changed:  # least fingerprint that is reached
        changed = False
        for a, p in prints.items():
            best = min(group[b] for b, q in prints.items() if (p ^ q).bit_count() <= 4)
            changed |= best != group[a]
            group[a] = best
    smallest = {}
    for i, t, _ in rows:
        if i is not None:
            smallest[group[t]] = min(i, smallest.get(group[t], i))
    got = simhash.near_duplicates(odd).collect()
    assert by_text((r.doc_id, r.fingerprint, r.component_id) for r in got) == by_text((i, f"{prints[t]:016x}", smallest.get(group[t])) for i, t, _ in rows)
    kept = [(r.doc_id, r.text) for r in simhash.keep_one(odd).select("doc_id", "text").collect()]
    assert sum(i is None for i, _ in kept) == 1000
    assert {i for i, _ in kept if i is not None} == set(smallest.values())
    assert sum(i == 1 for i, _ in kept) == len({group[t] for i, t, _ in rows if i == 1})


def test_links_of_crowded_shards(spark, monkeypatch):
    """Fingerprints that share most bits: dealt again by eight blocks, then into chunks."""
    monkeypatch.setattr(simhash, "SHARD", 8)
    import numpy as np

    rng = np.random.default_rng(4)
    values = sorted({(1 << 40) + int(x) for x in rng.integers(0, 1 << 14, 300)})
    links = simhash.links(spark.createDataFrame([(v,) for v in values], "fp long")).collect()
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for u, v in links:
        root[max(find(u), find(v))] = min(find(u), find(v))
    want = {v: v for v in values}
    for a in values:
        for b in values:
            if (a ^ b).bit_count() <= 4 and want[a] != want[b]:
                old, new = max(want[a], want[b]), min(want[a], want[b])
                want = {k: new if x == old else x for k, x in want.items()}
    assert {v: find(v) for v in values} == want


def test_mixing_reaches_targets(spark, odd, rows, tmp_path):
    """Sources of rows without id, and of equal rows."""
    rows = rows + [(7, "ten words of one text that is here many times", "d")] * 300 + [(8 + i, "w " * 50, "e") for i in range(40)]
    docs = spark.createDataFrame([(i, t, s) for i, t, s in rows], "doc_id long, text string, source string")
    out = {}
    for r in mixing.take(docs).collect():
        out.setdefault((r.source_size, r.target), []).append((r.size, r.taken))
    assert sum(map(len, out.values())) == len(rows)
    for (_, target), taken in out.items():
        assert abs(sum(t for _, t in taken) - target) <= max(s for s, _ in taken)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    same(mixing.op4_mix_sources(spark, str(tmp_path)), one_table(tmp_path, "documents"), mixing.OP4_SQL)
    kept = mixing.copies(docs).groupBy("source").agg({"copies": "sum"}).collect()
    taken = mixing.take(docs).where("size > 0").selectExpr("sum(taken / size)").first()[0]
    assert sum(r[1] for r in kept if r[0] != "c") == taken


def test_personal_data(spark, odd, rows):
    import hashlib

    got = pii.find_personal_data(odd).collect()
    assert by_text((r.doc_id, r.base_sha256) for r in got) == by_text((i, hashlib.sha256(personal(t).encode()).hexdigest()) for i, t, _ in rows)
    many = " ".join(f"see 10.{i % 250}.{i // 250 % 250}.7 with id{i}abc" for i in range(20_000))
    row = pii.find_personal_data(spark.createDataFrame([(1, many)], "doc_id long, text string")).first()
    assert row.n_ip == 20_000 and row.base_sha256 == hashlib.sha256(personal(many).encode()).hexdigest()


def test_bootstrap_scores(spark):
    """Patterns and instances against the same rules in plain Python; a second round finds what only the first one's instances show."""
    edges = [(0, "mail to", 0, f"u{i}@x.y", 2) for i in range(4)] + [(0, "mail to", pii.OTHER, "agent007", 1), (0, "mail to", pii.OTHER, "agent008", 1)]
    edges += [(1, "is staff", 0, "u1@x.y", 3), (1, "is staff", pii.OTHER, "agent007", 4), (1, "is staff", pii.OTHER, "agent008", 4), (1, "is staff", pii.OTHER, "agent009", 1)]
    edges += [(2, "a | b", 1, "1.2.3.4", 9), (2, "a | b", pii.OTHER, "agent010", 1)]
    patterns, found = pii.bootstrap(spark.createDataFrame(edges, "shape int, context string, kind int, hit string, n long"))
    patterns = {(r.shape, r.context, r.kind): r.confidence for r in patterns.collect()}
    found = {r.hit: (r.kind, r.score) for r in found.collect()}
    first = 8 / 10
    assert found["agent007"] == found["agent008"] == (0, pytest.approx(first))
    staff = (3 + 8 * first) / 12
    assert staff < pii.MIN_CONFIDENCE and set(patterns) == {(0, "mail to", 0)} and "agent009" not in found and "agent010" not in found
    edges[6] = (1, "is staff", 0, "u1@x.y", 30)
    patterns, found = pii.bootstrap(spark.createDataFrame(edges, "shape int, context string, kind int, hit string, n long"))
    patterns = {(r.shape, r.context, r.kind): r.confidence for r in patterns.collect()}
    found = {r.hit: (r.kind, r.score) for r in found.collect()}
    assert (1, "is staff", 0) in patterns and found["agent009"][0] == 0


def test_licenses_in_long_texts(spark, odd):
    assert licenses.scan(odd).isEmpty()
    mit = licenses.TEMPLATES["MIT"]
    texts = [(None, f"{LONG} {mit}"), (1, " ".join(["released under the mit permission"] * 20_000)), (2, mit + " and " + " ".join(f"w{i}" for i in range(1_000_000)))]
    got = {(r.doc_id, r.template_id) for r in licenses.scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == {(None, "MIT"), (2, "MIT")}
    table_ = spark.createDataFrame([("own", "one two three four five six"), (None, "x"), ("short", None)], "template_id string, text string")
    docs = spark.createDataFrame([(1, "zero one two three four five six seven")], "doc_id long, text string")
    assert [(r.template_id, r.containment) for r in licenses.scan(docs, table_).collect()] == [("own", 1.0)]
