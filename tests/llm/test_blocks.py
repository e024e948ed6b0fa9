"""Blocks and tables of texts that have no window, crowded windows, hosts and templates beyond ASCII."""

from __future__ import annotations

import time

import numpy as np
import pytest
from test_llm import by_text, contaminated, cut_bytes, cut_words

from cytospark.llm import decontaminate, fingerprint_index, licenses, lines, repeats, suffix_doubling


@pytest.mark.parametrize("spec", [fingerprint_index.SPEC, suffix_doubling.SPEC])
def test_runs_of_short_texts(spec):
    for texts in ([], [b""], [b"x" * 60, b"y" * 60], [b"one two three four five six seven eight"] * 20):
        runs = repeats.runs_of(spec, texts)
        assert len(runs.low) == len(runs.g) == 0 and len(runs.first) == len(texts)


def test_tables_and_batches_of_short_texts(spark):
    short = [(i, "one two three four five six seven eight nine") for i in range(40)]
    long = [(100, " ".join(f"w{i}" for i in range(60))), (101, "x " + " ".join(f"w{i}" for i in range(50)))]
    for rows in (short, long[:1] + short + [(200 + i, t) for i, t in short] + long[1:]):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        found = fingerprint_index.find_repeats(df, 3)
        got = repeats.finish(fingerprint_index.SPEC, df, found, fingerprint_index._digest, "n_words bigint, n_removed bigint, kept_sha256 string")
        assert by_text(tuple(r) for r in got.collect()) == by_text(cut_words(rows))
        got = repeats.finish(suffix_doubling.SPEC, df, repeats.replies_of(repeats.run_rows(suffix_doubling.SPEC, repeats.keyed_documents(df)), "t"), suffix_doubling._digest, "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
        assert by_text(tuple(r) for r in got.collect()) == by_text(cut_bytes(rows))
        assert fingerprint_index.remove_repeats(df).count() == suffix_doubling.remove_repeats(df).count() == len(rows)


def longest_plain(text: str, item: str) -> tuple[int, int, int]:
    """(words, place in the text, place in the item) of the longest common run of words, the first of equal ones."""
    w, q = text.split(), item.split()
    best = (0, 0, 0)
    for a in range(len(w)):
        for b in range(len(q)):
            n = 0
            while a + n < len(w) and b + n < len(q) and w[a + n] == q[b + n]:
                n += 1
            best = max(best, (n, -a, -b))
    return best[0], -best[1], -best[2]


def test_many_places_of_many_items(spark):
    """Random words of a small vocabulary, so that windows are crowded, and items of one word."""
    rng = np.random.default_rng(2)
    pick = lambda n, k=3: " ".join(f"v{i}" for i in rng.integers(0, k, n))
    rows = [(i, pick(int(rng.integers(0, 120)))) for i in range(25)] + [(90, "yes " * 300), (91, "no"), (None, "yes")]
    items = [(i, pick(int(rng.integers(1, 5)))) for i in range(6)] + [(50 + i, pick(40, 2)) for i in range(4)] + [(80 + i, "yes") for i in range(5)] + [(99, "yes " * 30)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for part in (10**7, 100):
        assert by_text(tuple(r) for r in decontaminate.contamination(df, bench, part).collect()) == by_text(contaminated(rows, items))
    texts, of = dict(rows), {str(i): t for i, t in items}
    q = decontaminate.prepare(items)
    found = decontaminate.search_block(q, [t.encode() for t in texts.values()])
    for text, hits in zip(texts.values(), found.hits, strict=True):
        for item, item_word, doc_word, n in hits:
            assert (n, doc_word, item_word) == longest_plain(text, of[item])
        assert len({h[0] for h in hits}) == len(hits)


def test_crowded_windows_take_linear_time():
    q = decontaminate.prepare([(i, "yes") for i in range(60)])
    began = time.process_time()
    found = decontaminate.search_block(q, [b"yes " * 20_000])
    assert time.process_time() - began < 2 and found.spans == [[(0, 20_000)]] and len(found.hits[0]) == 60


def test_hashes_that_agree_are_compared_by_bytes(monkeypatch):
    """With hashes of two bits nearly all words look like words of the benchmark."""
    real = decontaminate.Rolling

    class Poor(real):
        def __call__(self, starts, ends):
            return super().__call__(starts, ends) & np.uint64(3)

    items = [(1, "aa bb")]
    monkeypatch.setattr(decontaminate, "Rolling", Poor)
    q = decontaminate.prepare(items)
    assert [h for h in decontaminate.search_block(q, [b"cc dd ee ff gg hh"]).hits[0]] == []


def test_hosts(spark):
    cases = {
        "http://user:pw@Example.com:80/x": "example.com",
        "https://a.b/c@d?e#f": "a.b",
        "http://me@you@host.org?x=1": "host.org",
        "//cdn.net/lib.js": "cdn.net",
        "site.org/page": "site.org",
        "other.org:8080/page": "other.org",
        "http://[2001:DB8::1]:443/": "[2001:db8::1]",
        "ftp://HOST": "host",
        "http:///path": "",
        "": "",
        None: None,
    }
    df = spark.createDataFrame([(u,) for u in cases], "url string")
    assert {r.url: r.host for r in df.select("url", lines.host_of(df.url).alias("host")).collect()} == cases


def test_template_beyond_ascii(spark):
    text = "Équitablement réparties Selon les règles Établies par les auteurs de cette œuvre"
    templates = spark.createDataFrame([("fr", text), (None, "x"), ("short", "a b")], "template_id string, text string")
    docs = spark.createDataFrame([(1, f"Avant. {text} Après."), (2, "autre chose"), (3, None)], "doc_id long, text string")
    assert [(r.doc_id, r.template_id, r.containment) for r in licenses.scan(docs, templates).collect()] == [(1, "fr", 1.0)]
