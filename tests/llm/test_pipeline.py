"""Each stage of the pipeline against a plain version of its decision, on what the stage before it kept."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import corpus_pipeline
import duckdb
import numpy as np
import pytest
from test_llm import simple_print

from cytospark.llm import mixing, toxicity
from cytospark.llm.common import materialize, table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def chain(spark, small):
    """The rows before the first stage and after each, as tuples, and the last stage's input as a table."""
    docs = table(spark, small, "documents")
    rows, inputs = [[tuple(r) for r in docs.collect()]], [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, inputs[-1], small), name)
        rows.append([tuple(r) for r in docs.collect()])
        inputs.append(docs)
    return docs.columns, rows, inputs


def check(got, want):
    assert Counter(map(str, got)) == Counter(map(str, want))


def test_toxicity(spark, small, chain):
    """One document at a time, word by word."""
    names, rows, inputs = chain
    model = toxicity.fit(toxicity.labelled_features(inputs[0], table(spark, small, "labels")))
    weight = dict(zip(model["words"].tolist(), model["weights"].tolist(), strict=True))
    kept = []
    for row in rows[0]:
        own = set()
        for w in re.findall(rb"[a-z0-9\x80-\xff]+", (row[names.index("text")] or "").encode().lower()):
            own |= set(toxicity._word_sets([w])[1].tolist())
        z = sum(weight.get(h, 0.0) for h in own)
        if 1 / (1 + np.exp(-(z - model["theta"][-1]))) < toxicity.CUTOFF:
            kept.append(row)
    check(rows[1], kept)
    assert len(kept) < len(rows[0])


def test_lines(chain):
    """Lines on over a tenth of a source's documents, and on two, go, but for documents of nothing else."""
    names, rows, _ = chain
    text, source = names.index("text"), names.index("source")
    pages, seen = Counter(r[source] for r in rows[1]), defaultdict(Counter)
    for r in rows[1]:
        seen[r[source]].update({x.strip(" ") for x in (r[text] or "").split("\n")} - {""})
    want = []
    for r in rows[1]:
        lines = (r[text] or "").split("\n")
        stay = [x for x in lines if not (x.strip(" ") and seen[r[source]][x.strip(" ")] >= 2 and seen[r[source]][x.strip(" ")] > pages[r[source]] * 0.1)]
        new = "\n".join(stay if any(x.strip(" ") for x in stay) else lines)
        want.append((*r[:text], None if r[text] is None else new, *r[text + 1 :]))
    check(rows[2], want)
    assert rows[2] != rows[1]


def test_near_duplicates(chain):
    """All pairs of fingerprints; of each group of linked ones the smallest doc_id stays."""
    names, rows, _ = chain
    i, text = names.index("doc_id"), names.index("text")
    prints = {r[i]: simple_print(r[text]) for r in rows[2]}
    near, done, kept = {a: [b for b in prints if (prints[a] ^ prints[b]).bit_count() <= 4] for a in prints}, set(), set()
    for a in sorted(prints):
        if a not in done:
            kept.add(a)
            todo = [a]
            while todo:
                b = todo.pop()
                if b not in done:
                    done.add(b)
                    todo += near[b]
    check(rows[3], [r for r in rows[2] if r[i] in kept])
    assert len(kept) < len(rows[2])


def test_decontamination(spark, small, chain):
    """Windows of 13 words (or a whole shorter item) by a set; a twentieth of the words is too much."""
    names, rows, _ = chain
    windows = defaultdict(set)
    for r in table(spark, small, "benchmark").collect():
        w = WORD.findall((r.text or "").translate(LOWER))
        n = min(13, len(w))
        windows[n].update(tuple(w[a : a + n]) for a in range(len(w) - n + 1) if n)
    kept = []
    for r in rows[3]:
        w, hit = WORD.findall((r[names.index("text")] or "").translate(LOWER)), set()
        for n, some in windows.items():
            for a in range(len(w) - n + 1):
                if tuple(w[a : a + n]) in some:
                    hit.update(range(a, a + n))
        if not hit or 20 * len(hit) < len(w):
            kept.append(r)
    check(rows[4], kept)
    assert len(kept) < len(rows[3])


def test_mixing(chain):
    """Copies against the SQL of the mix over the stage's own input."""
    names, rows, inputs = chain
    con = duckdb.connect()
    con.register("documents", inputs[4].toArrow())
    found = con.execute(mixing.OP4_SQL)
    at = [[d[0] for d in found.description].index(n) for n in ("doc_id", "size", "taken")]
    taken = {r[at[0]]: (r[at[1]], r[at[2]]) for r in found.fetchall()}
    size = lambda r: len(re.findall(rb"[^\x20\x09-\x0D]+", (r[names.index("text")] or "").encode()))
    got = {r[names.index("doc_id")]: (size(r), size(r) * r[-1]) for r in rows[5]}
    assert names[-1] == "copies" and all(0 < r[-1] <= 2 for r in rows[5])
    assert {k: v for k, v in got.items() if v[0]} == {k: v for k, v in taken.items() if v[1]}
    check([r[:-1] for r in rows[5]], [r for r in rows[4] if r[names.index("doc_id")] in got])


def test_run_is_the_chain(spark, small, chain):
    check([tuple(r) for r in corpus_pipeline.run(spark, small).collect()], chain[1][5])
