"""Text operators against brute force, on the smallest tables and on rows of edge cases."""

from __future__ import annotations

import hashlib
import re
import shutil
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from oracle import connect, same

from cytospark.llm import decontaminate, fingerprint_index, licenses, lines, merkle, mixing, pii, ranks, registry, repeats, simhash, suffix_doubling, toxicity
from cytospark.llm.common import table

SPACE = rb"[^\x20\x09-\x0D]+"
LONG = " ".join(f"w{i % 997}" for i in range(30_000))
PASSAGE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
EDGE = [
    (1, "  ", "a"),
    (2, None, "a"),
    (3, "", None),
    (4, LONG, "b"),
    (5, f"before {PASSAGE} after", "b"),
    (6, f"{PASSAGE} and {PASSAGE}", "b"),
    (6, f"{PASSAGE} and {PASSAGE}", "b"),
    (7, "ÄÖ ß 中文 😀 mixed.Case UPPER", "c"),
    (None, f"x {PASSAGE} y", "c"),
    (8, LONG + " end", "c"),
    (9, "short text", "c"),
]


@pytest.fixture(scope="module")
def edge(spark):
    """Null, empty, very long, repeated and tied rows, with columns whose names the operators use themselves."""
    rows = [(i, t, "en", s, len(t or ""), 7, "x", "y") for i, t, s in EDGE]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key long, copies string, lines string")


@pytest.fixture(scope="module")
def docs(spark, small):
    return [tuple(r) for r in table(spark, small, "documents").select("doc_id", "text").orderBy("doc_id").collect()]


def one_table(folder, name):
    """DuckDB with a table that a test has written."""
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    return con


def words(text):
    return [w.decode() for w in re.findall(SPACE, (text or "").encode())]


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_sql(spark, small, name):
    same(registry.QUERIES[name](spark, small), connect(small), registry.ORACLES[name])


def contaminated(rows, items):
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    low = lambda t: re.findall(word, (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    out = []
    for i, t in rows:
        w, hit, ids = low(t), set(), set()
        for item, text in items:
            q = low(text)
            n = min(13, len(q))
            for a in range(len(q) - n + 1) if n else ():
                for b in range(len(w) - n + 1):
                    if w[b : b + n] == q[a : a + n]:
                        hit.update(range(b, b + n))
                        ids.add("" if item is None else str(item))
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def by_text(rows):
    return sorted(map(str, rows))


@pytest.mark.parametrize("part_bytes", [10**7, 200])
def test_decontamination_edges(spark, edge, part_bytes):
    items = [(1, PASSAGE), (2, "short"), (3, None), (None, "w1 w2 w3 w4 w5"), (5, ""), (1, PASSAGE)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(edge, bench, part_bytes)
    want = contaminated([(i, t) for i, t, _ in EDGE], items)
    assert by_text(tuple(r) for r in got.collect()) == by_text(want)
    assert decontaminate.remove_contaminated(edge, bench).columns == edge.columns
    longest = {(r.doc_id, r.item_id): (r.doc_word, r.n_words) for r in decontaminate.longest_matches(edge, bench).collect()}
    assert longest[5, "1"] == (1, 15) and longest[6, "1"] == (0, 15)


def test_decontamination_empty(spark, edge):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(edge, none).where("contaminated").count() == 0
    assert decontaminate.contamination(edge.where("false"), none).count() == 0


def simple_print(text):
    w = re.findall(SPACE, (text or "").encode().lower())
    grams = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    total = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g, 42)
        for b in range(64):
            total[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * total[b] > len(grams))


def test_simhash(spark, small, docs):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op3_simhash_near_dedup(spark, small).collect()}
    prints = {i: simple_print(t) for i, t in docs}
    root = {i: i for i in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert got == {i: (f"{p:016x}", find(i)) for i, p in prints.items()}


def test_simhash_edges(spark, edge):
    got = sorted((str(r.doc_id), r.component_id) for r in simhash.near_duplicates(edge).collect())
    assert len(got) == len(EDGE) and {c for i, c in got if i in "123"} == {1}
    kept = simhash.keep_one(edge)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == edge.columns and ids.count(6) == 1 and ids.count(1) == 1 and 2 not in ids and 3 not in ids
    assert simhash.near_duplicates(edge.where("false")).count() == 0


@pytest.mark.parametrize("p_null, n_ids", [(0.3, 15), (0.3, 10**6), (0.0, 8)])
def test_keep_one_of_repeated_and_missing_ids(spark, p_null, n_ids):
    """Rows without id, and rows of one id with different texts, against brute force."""
    rng = np.random.default_rng(5)
    base = [" ".join(f"t{k}x{x}" for x in rng.integers(0, 10**6, 300)) for k in range(25)]
    texts = [base[k] + " more" * int(rng.integers(0, 2)) for k in rng.integers(0, len(base), 80)]
    rows = [(None if rng.random() < p_null else int(rng.integers(0, n_ids)), t) for t in texts]
    signed = {t: simple_print(t) - (simple_print(t) >> 63 << 64) for t in texts}
    root = {t: t for t in texts}
    for a in root:
        for b in root:
            if ((signed[a] ^ signed[b]) & (2**64 - 1)).bit_count() <= 4 and root[a] != root[b]:
                old, new = root[a], root[b]
                root.update({x: new for x in root if root[x] == old})
    want, by_component, first = [(None, t) for i, t in rows if i is None], {}, {}
    for i, t in rows:
        if i is not None:
            by_component.setdefault(root[t], []).append((i, signed[t], t))
    for c, found in by_component.items():
        first[c] = min(found)[0]
        want.append((first[c], min(found)[2]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert by_text((r.doc_id, r.text) for r in simhash.keep_one(docs).collect()) == by_text(want)
    got = simhash.near_duplicates(docs).collect()
    assert by_text((r.doc_id, r.fingerprint, r.component_id) for r in got) == by_text((i, f"{signed[t] & (2**64 - 1):016x}", first.get(root[t])) for i, t in rows)


def test_bk_tree_in_chunks():
    rng = np.random.default_rng(3)
    base = [int(x) for x in rng.integers(0, 2**63, 40)]
    values = base + [b ^ (1 << int(k)) ^ (1 << int(j)) for b, k, j in zip(base, rng.integers(0, 60, 40), rng.integers(0, 60, 40), strict=True)]
    links = simhash.shard_links(values, [i // 40 for i in range(80)])
    assert {(max(values[i], values[40 + i]), min(values[i], values[40 + i])) for i in range(40)} <= set(links)


def test_mixing_edges(spark, edge):
    got = mixing.take(edge).collect()
    assert len(got) == len(EDGE)
    total = sum(len(words(t)) for _, t, _ in EDGE)
    assert sum({r.target for r in got}) <= 1.5 * total + 1e-3
    assert all(r.taken <= 2 * r.size and r.target <= 2 * r.source_size for r in got)
    assert by_text(tuple(r) for r in got) == by_text(tuple(r) for r in mixing.take(edge).collect())
    out = mixing.copies(edge)
    assert sorted(out.columns) == sorted(edge.columns) and out.where("copies < 1").count() == 0
    assert mixing.take(edge.where("false")).count() == 0


def test_mixing_meets_targets(spark, small):
    rows = mixing.op4_mix_sources(spark, small)
    sums = table(spark, small, "documents").select("doc_id", "source").join(rows, "doc_id").groupBy("source").agg({"taken": "sum", "target": "max", "size": "max"}).collect()
    assert all(abs(r["sum(taken)"] - r["max(target)"]) <= r["max(size)"] for r in sums)


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(v - 9 * (v > 9) for i, c in enumerate(reversed(digits)) for v in [int(c) * (1 + i % 2)]) % 10 == 0


def personal(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "email" or (kind == "ip" and all(int(x) <= 255 for x in m.group().split("."))) or (kind == "card" and 14 <= len(digits) <= 19 and luhn(digits)) or (kind == "phone" and 10 <= len(digits) <= 15):
                out.append((m.start(), k, m.end()))
    return ",".join(f"{list(PATTERNS)[k]}:{a}:{b}" for a, k, b in sorted(out))


def test_personal_data(spark, docs):
    extra = ["a@b.c%d@e.f x", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "+1 (389) 555-5010 +1", "ü😀 a.b@c-d.e..f é", "a@b@c.com", "9" * 5000, "a@" + "b." * 5000 + "c", None, "", "0255.0.1.2.3"]
    rows = docs + [(10**6 + i, t) for i, t in enumerate(extra)] + [(None, "x@y.z"), (10**6, "again 1.2.3.4")]
    got = pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert by_text((r.doc_id, r.base_sha256) for r in got) == by_text((i, hashlib.sha256(personal(t).encode()).hexdigest()) for i, t in rows)
    assert pii.find_personal_data(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_contexts_discover_identifiers(spark):
    rows = [(i, f"please write employee mail u{i}@site{i}.org today") for i in range(20)] + [(99, "please write employee mail agent007x today")]
    got = {r.doc_id: r.spans for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[99] == "email:27:36" and got[0] == "email:27:39"


def plain_pieces(text):
    """Pieces by section and paragraph, without trees."""
    out = []
    for section in text.encode().split(b"\n\n") if text else []:
        out.append([])
        for paragraph in section.split(b"\n"):
            own, last, n = [], 0, 0
            for m in re.finditer(rb"\S+\s*", paragraph):
                n += 1
                if n == 3 or m.group().split()[0][-1:] in (b".", b"!", b"?", b",", b";", b":"):
                    own.append(paragraph[last : m.end()])
                    last, n = m.end(), 0
            out[-1].append(own + ([paragraph[last:]] if last < len(paragraph) else []))
    return out


def plain_root(text):
    h = lambda tag, parts: hashlib.blake2b(tag + b"".join(parts), digest_size=16).digest()
    return h(b"\3", [h(b"\2", [h(b"\1", [h(b"\0", [x]) for x in p]) for p in s]) for s in plain_pieces(text)]).hex()


def plain_likeness(a, b):
    x, y = (Counter(x for s in plain_pieces(t) for p in s for x in p) for t in (a, b))
    return 1.0 if a == b else (x & y).total() / max(1, (x | y).total())


def test_merkle(spark, small, docs):
    got = {r.doc_id: r for r in merkle.op6_merkle_fingerprints(spark, small).collect()}
    down = sorted(docs, reverse=True)
    for k, (i, t) in enumerate(down):
        half = len(t) // 2
        edited = t[: len(t) - half] + down[(k + 1) % len(down)][1][:half]
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (got[i].fingerprint, got[i].edited_fingerprint) == (plain_root(t), plain_root(edited))
        assert got[i].near_edited == pytest.approx(plain_likeness(t, edited)) and got[i].near_next == pytest.approx(plain_likeness(t, down[(k + 1) % len(down)][1]))
    assert len({r.fingerprint for r in got.values()}) == len({t for _, t in docs})


def test_merkle_edges(spark, edge):
    got = merkle.fingerprint_pairs(edge).collect()
    assert len(got) == len(EDGE) and sum(r.doc_id is None for r in got) == 1
    single = merkle.fingerprint_pairs(edge.where("doc_id = 9")).first()
    assert single.near_next == 1.0
    assert merkle.fingerprint_pairs(edge.where("false")).count() == 0
    a, b = merkle.tree(b"one\ntwo\n\nthree"), merkle.tree(b"one\nTWO\n\nthree")
    assert merkle.edits(a, b) == [(0, 1)] and merkle.edits(a, a) == []
    assert b"".join(merkle.pieces(b"  a b c. d  ")) == b"  a b c. d  "


def test_lines_both_ways(spark):
    rows = [(i, "menu\n\nstory %d\nmenu" % i, "h" if i % 2 else None) for i in range(40)] + [(100, "menu", "h"), (101, None, "h"), (102, "", "h")]
    docs = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in lines.drop_lines(docs).collect()}
    assert got[1] == "\nstory 1" and got[100] == "" and got[101] is None and got[102] == ""
    got = {r.doc_id: r.text for r in lines.drop_lines(docs, keep_whole=True).collect()}
    assert got[1] == "\nstory 1" and got[2] == "\nstory 2" and got[100] == "menu" and got[101] is None and got[102] == ""
    from pyspark.sql import functions as F

    wide = [sorted(map(str, lines.drop_boilerplate(docs, F.col("source"), F.split("text", "\n", -1), broadcast_bytes=b).select("doc_id", "__kept").collect())) for b in (10**9, 0)]
    assert wide[0] == wide[1]
    assert lines.drop_lines(docs.where("false")).count() == 0


def test_all_boilerplate_goes(spark, tmp_path):
    """Menus go from hosts of two pages, and pages of boilerplate only become empty."""
    page = lambda *x: "<body><nav>menu</nav>" + "".join(f"<p>{t}</p>" for t in x) + "<footer>imprint</footer></body>"
    rows = [(1, "http://two/a", page("one")), (2, "http://two/b", page("two")), (3, "http://one/", page("alone"))]
    rows += [(10 + i, f"http://many/{i}", page(f"story {i}")) for i in range(30)] + [(50, "http://many/stub", page()), (51, "http://many/null", None)]
    rows += [(60 + i, None, page(f"tale {i}")) for i in range(10)] + [(None, "http://many/", page("w " * 20_000)), (70, "http://empty/", "")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    same(lines.op7_line_dedup(spark, str(tmp_path)), one_table(tmp_path, "pages"), registry.ORACLES["op7_line_dedup"])
    got = {r.page_id: (r.n_lines, r.n_dropped, r.kept_text) for r in lines.op7_line_dedup(spark, str(tmp_path)).collect()}
    assert got[60] == (3, 2, "tale 0") and got[51] == (0, 0, None) and got[70] == (0, 0, "")
    assert got[1] == (3, 2, "one") and got[2] == (3, 2, "two") and got[3] == (3, 0, "menu\nalone\nimprint")
    assert got[50] == (2, 2, "") and all(got[10 + i] == (3, 2, f"story {i}") for i in range(30)) and len(got) == len(rows)


def cut_words(rows):
    first, out = {}, []
    for i, t in rows:
        w = words(t)
        for a in range(len(w) - 12):
            k = tuple(w[a : a + 13])
            key = float("inf") if i is None else i
            first[k] = min(first.get(k, key), key)
    for i, t in rows:
        w, gone = words(t), set()
        for a in range(len(w) - 12):
            if first[tuple(w[a : a + 13])] < (float("inf") if i is None else i):
                gone.update(range(a, a + 13))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def cut_bytes(rows):
    seen, out = {}, []
    for row, (i, t) in enumerate(rows):
        b = (t or "").encode()
        for a in range(len(b) - 99):
            seen.setdefault(b[a : a + 100], []).append((float("inf") if i is None else i, row, a))
    first = {k: min(v)[0] for k, v in seen.items()}
    own = {}
    for k, v in seen.items():
        for _, row, a in v:
            own[k, row] = min(own.get((k, row), a), a)
    for row, (i, t) in enumerate(rows):
        b = (t or "").encode()
        cut = np.zeros(len(b) + 1, np.int8)
        for a in range(len(b) - 99):
            k = b[a : a + 100]
            if first[k] < (float("inf") if i is None else i) or own[k, row] < a:
                cut[a : a + 100] = 1
        kept = bytes(x for x, c in zip(b, cut, strict=False) if not c)
        out.append((i, len(b), int(cut.sum()), int((np.diff(cut, prepend=np.int8(0)) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def varied():
    """Passages that end differently in many documents, nested and periodic repeats."""
    rng = np.random.default_rng(5)
    vocab = [f"v{i}" for i in range(4000)]
    pick = lambda n: " ".join(vocab[int(i)] for i in rng.integers(0, 4000, n))
    shared = pick(40)
    rows = [(i, f"{pick(20)} {shared} {pick(20)}") for i in range(30)]
    rows += [(100 + i, f"{pick(3)} {' '.join(shared.split()[i : i + 20])} {pick(5)}") for i in range(20)]
    return rows + [(200, "na " * 300), (201, "na " * 200 + "x"), (202, pick(300) + " " + shared + " " + shared)]


def test_repeats_edges(spark, edge):
    rows = [(i, t) for i, t, _ in EDGE if t != LONG + " end"] + varied()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for batches in (1, 3, 6):
        got = repeats.finish(fingerprint_index.SPEC, df, fingerprint_index.find_repeats(df, batches), fingerprint_index._digest, "n_words bigint, n_removed bigint, kept_sha256 string")
        assert by_text(tuple(r) for r in got.collect()) == by_text(cut_words(rows))
    got = repeats.finish(suffix_doubling.SPEC, df, repeats.replies_of(repeats.run_rows(suffix_doubling.SPEC, repeats.keyed_documents(df)), "t"), suffix_doubling._digest, "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    assert by_text(tuple(r) for r in got.collect()) == by_text(cut_bytes(rows))
    none = df.where("false")
    assert fingerprint_index.remove_repeats(none).count() == 0 and suffix_doubling.remove_repeats(none).count() == 0


def test_suffix_doubling(spark, small, docs):
    got = suffix_doubling.op9_suffix_array_dedup(spark, small)
    assert by_text(tuple(r) for r in got.collect()) == by_text(cut_bytes(docs))


def test_prefix_doubling_of_all_suffixes(spark):
    """Places found by ranks of all suffixes, as the spans of the sparse form."""
    rows = [(None, f"x {PASSAGE} {PASSAGE} y"), (None, f"z {PASSAGE} {PASSAGE} y"), (5, "ä" * 300), (6, None), (6, PASSAGE * 2), (6, PASSAGE * 2), *varied()]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    places = {}
    for r in ranks.repeated_places(df).collect():
        places.setdefault(r.row, set()).update(range(r.at, r.at + 100))
    assert {i: len(p) for i, p in places.items()} == {k: n for k, (_, _, n, *_) in enumerate(cut_bytes(rows)) if n}


def test_index_opened_again(spark):
    """Batches added in two sessions, with compaction; older runs aren't moved."""
    rows = [(i, t) for i, t in varied() if i is not None]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    index = fingerprint_index.FingerprintIndex(spark, max_runs=2)
    found = index.add(df.where("doc_id < 10")).unionByName(index.add(df.where("doc_id >= 10 AND doc_id < 25")))
    later = spark.newSession()
    again = fingerprint_index.FingerprintIndex(later, index.folder, max_runs=2)
    assert again.runs == index.runs and len(again.runs) == 2 and again.buckets == index.buckets
    docs = later.createDataFrame(rows, "doc_id long, text string")
    for low, high in ((25, 110), (110, 1000)):
        more = again.add(docs.where(f"doc_id >= {low} AND doc_id < {high}"))
        found = found.unionByName(spark.read.parquet(*more.inputFiles()) if more.inputFiles() else found.limit(0))
    assert len(again.runs) == 2 and again._old(again.runs[0]).groupBy("g", "s").count().where("count > 1").isEmpty()
    got = repeats.finish(fingerprint_index.SPEC, df, repeats.by_document(found), fingerprint_index._digest, "n_words bigint, n_removed bigint, kept_sha256 string")
    assert by_text(tuple(r) for r in got.collect()) == by_text(cut_words(rows))
    with fingerprint_index._merging(later):
        plans = [again._opened(again.runs[-1]), again.compare(again.runs[-1], again._write(again._opened(again.runs[-1])))]
        plan = " ".join(p._jdf.queryExecution().executedPlan().toString() for p in plans)
    assert "Exchange" not in plan and "SortMergeJoin" in plan


def test_toxicity_of_many_words(spark):
    """More words than 16 bits number all become features, and each has its say."""
    n = 70_000
    texts = [" ".join(f"{'bad' if toxic else 'good'}{i}" for i in range(n // 2)) for toxic in (0, 1)]
    docs = spark.createDataFrame([(i, texts[i % 2]) for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(60)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(toxicity.labelled_features(docs, labels))
    assert len(model["words"]) >= n and len(model["weights"]) == len(model["words"])
    p = toxicity.probabilities(model, [b"bad7 bad34999", b"good7 good34999", *[t.encode() for t in texts]])[:, -1]
    assert p[0] > p[1] and p[2] < 0.1 and p[3] > 0.9


@pytest.mark.parametrize("ends", [(10, 25, 110), (10, 110), (5, 10, 25, 105, 201)])
def test_index_answers_a_batch_alone(spark, tmp_path, ends):
    """Each batch is a table of its own, which is gone before the next one comes; documents without id come early, too."""
    rows = [r for r in varied() if r[0] is not None]
    index, got, low = fingerprint_index.FingerprintIndex(spark, max_runs=2), [], -1
    nobody = [(None, rows[3][1]), (None, "q " * 20), (None, f"{PASSAGE} {rows[7][1]}")]
    seen, want = [], []
    for n, end in enumerate([*ends, 10**6]):
        own = [r for r in rows if low <= r[0] < end] + nobody[n : n + 1]
        path = str(tmp_path / f"batch-{n}")
        spark.createDataFrame(own, "doc_id long, text string").write.parquet(path)
        got += [tuple(r) for r in index.answer(spark.read.parquet(path), fingerprint_index._digest, "n_words bigint, n_removed bigint, kept_sha256 string").collect()]
        shutil.rmtree(path)
        want += cut_words(seen + own)[len(seen) :]
        seen, low = seen + [r for r in own if r[0] is not None], end
    assert by_text(got) == by_text(want) and sum(r[2] for r in got) > 500
    assert len(index.runs) == len(index.windows) == 2 and index.highest == 202
    again = fingerprint_index.FingerprintIndex(spark, index.folder, max_runs=2)
    assert (again.runs, again.windows, again.texts, again.highest) == (index.runs, index.windows, index.texts, 202)
    with pytest.raises(ValueError, match="rising doc_id"):
        again.answer(spark.createDataFrame([(3, PASSAGE)], "doc_id long, text string"), fingerprint_index._digest, "n_words bigint, n_removed bigint, kept_sha256 string")


def test_toxicity_held_out(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.1", n) for n in ("documents", "labels"))
    model = toxicity.fit(toxicity.labelled_features(docs, labels.where("doc_id % 2 = 0")))
    rows = docs.join(labels.where("doc_id % 2 = 1"), "doc_id").select("text", "toxic").collect()
    p = toxicity.probabilities(model, [r.text.encode() for r in rows])[:, -1] >= toxicity.CUTOFF
    truth = np.array([r.toxic for r in rows], bool)
    assert (p == truth).mean() > 0.98 and p[~truth].mean() < 0.003 and p[truth].mean() > 0.75
    assert (np.diff(model["theta"]) > 0).all()


def test_ordinal_fit_is_the_optimum():
    """The fit against plain gradient descent, with numerical gradients, on the same penalised likelihood."""
    rng = np.random.default_rng(1)
    x = rng.random((300, 3)) < 0.4
    z = x @ np.array([2.0, -1.0, 0.5]) + rng.logistic(size=300)
    grade = (z > 0.5).astype(int) + (z > 2.0)
    rows = [(int(g), np.flatnonzero(r).astype("<u2").tobytes(), 1) for g, r in zip(grade, x, strict=True)]
    model = toxicity._ordinal(rows, np.arange(3, dtype=np.uint64))

    def loss(v):
        above = 1 / (1 + np.exp(-((x @ v[:3])[:, None] - v[3:])))
        s = np.concatenate((np.ones((300, 1)), above, np.zeros((300, 1))), 1)
        return -np.log(s[np.arange(300), grade] - s[np.arange(300), grade + 1]).mean() + toxicity.RIDGE * (v[:3] ** 2).sum() / 2

    v = np.array([0.0, 0.0, 0.0, -1.0, 1.0])
    for _ in range(3000):
        v -= 0.5 * np.array([(loss(v + e) - loss(v - e)) / 2e-5 for e in np.eye(5) * 1e-5])
    assert np.abs(np.concatenate((model["weights"], model["theta"])) - v).max() < 0.02


def test_scores_by_hand(spark):
    """Expected severity from words and stems looked up one by one."""
    docs = spark.createDataFrame([(i, f"vile{'' if i % 2 else 'ness indeed'} word{i}" if i < 40 else f"kind word{i}") for i in range(80)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i < 40)) for i in range(80)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(toxicity.labelled_features(docs, labels))
    weight = dict(zip(model["words"].tolist(), model["weights"].tolist(), strict=True))
    for r in toxicity.severity(docs, labels).collect():
        own = set()
        for w in docs.where(f"doc_id = {r.doc_id}").first().text.split() if r.doc_id in (1, 2, 41) else ():
            own |= set(toxicity._word_sets([w.encode()])[1].tolist())
        if own:
            z = sum(weight.get(w, 0.0) for w in own)
            p = [1 / (1 + np.exp(-(z - t))) for t in model["theta"]]
            assert r.expected_severity == pytest.approx(sum(p)) and r.p_toxic == pytest.approx(p[1]) and r.toxic == (p[1] >= 0.5) == (r.doc_id < 40)


def test_toxicity_edges(spark, edge):
    labels = spark.createDataFrame([(1, 1, None), (None, 1, 1), (77, 0, 1)], "doc_id long, quality int, toxic int")
    out = toxicity.severity(edge, labels)
    assert out.count() == len(EDGE) and out.where("toxic").count() == 0
    assert toxicity.remove_toxic(edge, labels).columns == edge.columns
    assert toxicity.severity(edge.where("false"), labels).count() == 0


def test_licenses_edges(spark, edge):
    mit = licenses.TEMPLATES["MIT"]
    rows = [(1, "foo " * 50 + mit + " bar" * 50), (2, mit.upper()), (3, " ".join(mit.split()[:20])), (4, None), (5, ""), (6, "Released under the MIT License."), (6, "Released under the MIT License.")]
    got = {(r.doc_id, r.template_id) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, "MIT"), (2, "MIT"), (6, "MIT-line")}
    assert licenses.scan(edge).count() == 0 and licenses.scan(edge.where("false")).count() == 0
    assert licenses.scan(edge, {"tiny": "a b"}).count() == 0


def test_licenses_short_lines_anywhere(spark):
    """Every planted line is found, in the first window that holds it."""
    line, n = "released under the mit license", 4000
    rng = np.random.default_rng(10)
    at = rng.integers(0, 60, n).tolist()
    rows = [(i, " ".join([*(f"a{x}" for x in rng.integers(0, 10**6, a)), line, *(f"b{x}" for x in rng.integers(0, 10**6, 60))])) for i, a in enumerate(at)]
    got = {r.doc_id: (r.template_id, r.containment, r.word) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    # windows of 12 words begin at every fourth
    assert got == {i: ("MIT-line", 1.0, max(0, (a - 7 + 3) // 4 * 4)) for i, a in enumerate(at)}


def test_licenses_bands_suffice():
    for t in licenses.TEMPLATES.values():
        w = licenses.template_words(t)
        n, m = len({tuple(w[i : i + 5]) for i in range(len(w) - 4)}), licenses.size_class(len(w))
        have = -(-4 * n // 5)
        least = have / (m + m // 2 - 4 + n - have)
        assert n <= licenses.FEW or (1 - least) ** licenses.bands_needed(n, m) <= 1e-6


def test_pipeline(spark, small):
    import corpus_pipeline

    docs = table(spark, small, "documents")
    names = docs.columns
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small)
        assert docs.columns == names, name
        now = docs.count()
        assert 0 < now <= before
        before = now
    assert corpus_pipeline.run(spark, small).count() > 0
