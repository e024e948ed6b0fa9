"""Alignment of two tokenizers against a plain version with dictionaries."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest

from cytospark.llm import alignment as A

ODD = ["", None, " ", "a  b ", "x   y", "tab\t x\n  y  \n\n z ", "a▁b c", "<s> <|endoftext|> </s>", "é è  ü　 x", "\x00 a", "emoji 😀 x  ", "it's they'll ' s", "  lead", "aé  b", "word word word", "ß ", "\u0085   x   y", "½ ﬁ x", "one " * 5000, "x" * 20000]
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def pair():
    return A.Pair(*A.load())


def brute(pair: A.Pair, rows: list[tuple]) -> list[tuple]:
    def ends(ids, side):
        out, end = {}, 0
        for i in ids:
            end += len(pair.bytes[side][i].as_py())
            out[end] = i
        return out

    docs, counts = [], Counter()
    for doc, text in rows:
        a = pair.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pair.b.encode(text) if text else []
        if any(b"".join(pair.bytes[k][i].as_py() for i in ids) != (" " + (text or "")).encode() for k, ids in enumerate((a, b))):
            a = b = []
        left, right = ends(a, 0), ends(b, 1)
        links = [(left[e], right[e]) for e in left if e in right]
        counts.update(links)
        groups, own = [], ([], [])
        for e in sorted({*left, *right}):
            own[0].extend([left[e]] if e in left else [])
            own[1].extend([right[e]] if e in right else [])
            if e in left and e in right:
                groups.append("|".join(",".join(map(str, x)) for x in own))
                own = ([], [])
        docs.append((doc, len(a), len(b), links, groups))
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [(doc, a, b, len(groups), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "") for doc, a, b, links, groups in docs]


def found(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def run(docs):
    blocks = A.align(docs, A.load())
    return A.documents_of(blocks, A.pair_counts(blocks))


def test_whole_table(spark, small, pair):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    assert found(A.op12_tokenizer_alignment(spark, small)) == sorted(brute(pair, rows), key=str)


def test_odd_texts_in_small_blocks(spark, pair, monkeypatch):
    rows = [(i if i % 5 else None, t) for i, t in enumerate(ODD + ODD[3:9])]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id int, text string, block string, pairs int").repartition(3)
    assert found(run(docs)) == sorted(brute(pair, rows), key=str)
    monkeypatch.setattr(A, "BLOCK", 50)
    assert found(run(docs)) == sorted(brute(pair, rows), key=str)


def test_empty_table_and_texts(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert run(docs).count() == 0
    docs = spark.createDataFrame([(1, None), (None, "")], "doc_id bigint, text string")
    assert found(run(docs)) == sorted([(1, 0, 0, 0, 0, 0, 0, ""), (None, 0, 0, 0, 0, 0, 0, "")], key=str)


def test_pieces_that_a_tokenizer_changes(pair, monkeypatch):
    """Where a longer text isn't given back, its pieces are encoded one by one."""
    texts = [t.encode() for t in ODD if t]
    want = [x.to_pylist() for x in A.tokens_of(pair, texts)]
    monkeypatch.setattr(A, "_joinable", lambda blob, at: [k + 2 < len(at) for k in range(len(at) - 1)])
    assert [x.to_pylist() for x in A.tokens_of(pair, texts)] == want
