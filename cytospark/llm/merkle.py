"""Document fingerprints by Merkle trees over sections, paragraphs and pieces of paragraphs.

Sections are divided by empty lines, paragraphs by line ends; a piece ends after a word with a closing mark, or after three words.
A leaf's hash covers the bytes of a piece, an inner node's the hashes of its children, with a tag for each level, so that
the root (128 bits of BLAKE2b) tells whether texts are equal, and differing branches lead to the places of edits.
The likeness of two trees is the share of leaves that they have in common, repeats counted (multiset Jaccard), 1 for equal roots. It is found on the
trees: branches with equal hashes share all their leaves and aren't entered, and only what lies below differing sections, and then below differing
paragraphs, is compared. As equal branches take the same leaves from both sides, this is the likeness of the whole multisets.

For `op6` each document needs the start of the next one. Documents are dealt by ranges of doc_id and sorted within; a task
then sees nearly every document together with its next. Only a task's first and last document wait for the other
tasks, and are paired in a second, small step. Texts are shuffled once.

Nulls and edge cases: a null text is empty; an empty text has a tree without leaves, whose likeness is 1 to another of this kind and else 0;
a null doc_id comes after all others; rows of the same doc_id follow each other by a hash of the text, then by text; a single document is its own next.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize, table, text_blocks

#: Words of a piece without closing mark, and bytes of a hash.
PIECE_WORDS, DIGEST = 3, 16

Paragraph = tuple[bytes, list[bytes]]
Section = tuple[bytes, list[Paragraph]]
Tree = tuple[bytes, list[Section]]


def _hash(tag: bytes, data: bytes) -> bytes:
    return hashlib.blake2b(tag + data, digest_size=DIGEST).digest()


def pieces(paragraph: bytes) -> list[bytes]:
    """The paragraph in pieces that joined give it again."""
    out, now = [], []
    for word in re.findall(rb"\s*\S+\s*|\s+", paragraph):
        now.append(word)
        if len(now) == PIECE_WORDS or word.rstrip()[-1:] in (b".", b"!", b"?", b",", b";", b":"):
            out.append(b"".join(now))
            now = []
    return out + ([b"".join(now)] if now else [])


def tree(text: bytes) -> Tree:
    """(root, [(section, [(paragraph, [leaf])])]) of hashes."""
    sections = []
    for section in text.split(b"\n\n") if text else []:
        paragraphs = []
        for paragraph in section.split(b"\n"):
            leaves = [_hash(b"\0", p) for p in pieces(paragraph)]
            paragraphs.append((_hash(b"\1", b"".join(leaves)), leaves))
        sections.append((_hash(b"\2", b"".join(p for p, _ in paragraphs)), paragraphs))
    return _hash(b"\3", b"".join(s for s, _ in sections)), sections


def _size(branch: Section | Paragraph) -> int:
    """Leaves below a section or paragraph."""
    return sum(_size(x) if isinstance(x, tuple) else 1 for x in branch[1])


def _shared(a: list, b: list) -> tuple[int, list, list]:
    """Leaves below the branches that both lists have, and the children of the branches that only one has."""
    theirs = Counter(x[0] for x in b)
    same, left = 0, []
    for x in a:
        if theirs[x[0]] > 0:
            theirs[x[0]] -= 1
            same += _size(x)
        else:
            left += x[1]
    right = []
    for y in b:
        if theirs[y[0]] > 0:
            theirs[y[0]] -= 1
            right += y[1]
    return same, left, right


def likeness(a: Tree, b: Tree) -> float:
    """Shared leaves by all leaves, repeats counted; 1 for equal roots. Only differing branches are entered."""
    if a[0] == b[0]:
        return 1.0
    sections, x, y = _shared(a[1], b[1])
    paragraphs, x, y = _shared(x, y)
    shared = sections + paragraphs + (Counter(x) & Counter(y)).total()
    total = sum(map(_size, a[1])) + sum(map(_size, b[1])) - shared
    return shared / max(1, total)


def edits(a: Tree, b: Tree) -> list[tuple[int, int]]:
    """(section, paragraph) positions whose branches differ; equal branches are not entered."""
    out = []
    for i in range(max(len(a[1]), len(b[1])) if a[0] != b[0] else 0):
        x, y = (t[1][i] if i < len(t[1]) else (b"", []) for t in (a, b))
        if x[0] != y[0]:
            out += [(i, j) for j in range(max(len(x[1]), len(y[1]))) if [p[0] for p in x[1][j : j + 1]] != [p[0] for p in y[1][j : j + 1]]]
    return out


def _pair(doc_id: int | None, text: str, own: Tree, following: str, next_tree: Tree) -> dict:
    """The result of one document, given the next one."""
    half = len(text) // 2
    edited = (text[: len(text) - half] + following[:half]).encode()
    edited_tree = tree(edited)
    return {"doc_id": doc_id, "n_chars": len(text), "edited_sha256": hashlib.sha256(edited).hexdigest(), "fingerprint": own[0].hex(), "edited_fingerprint": edited_tree[0].hex(), "near_edited": likeness(own, edited_tree), "near_next": likeness(own, next_tree)}


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
_PARTS = pa.schema([*_RESULT, ("part", pa.int64()), ("first_text", pa.string()), ("last_text", pa.string()), ("last_id", pa.int64())])
_RESULT_DDL = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs each document of a sorted task with the one after it; one more row carries the task's first and last document."""
    part = TaskContext.get().partitionId()
    first = last = None
    for batch, texts in text_blocks(batches):
        rows = []
        for doc_id, raw in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
            text, own = raw.decode(), tree(raw)
            if last is None:
                first = text
            else:
                rows.append(_pair(*last, text, own))
            last = (doc_id, text, own)
        yield pa.RecordBatch.from_pylist(rows, _PARTS)
    if last is not None:
        yield pa.RecordBatch.from_pylist([{"part": part, "first_text": first, "last_text": last[1], "last_id": last[0]}], _PARTS)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            row = _pair(r["last_id"], r["last_text"], tree(r["last_text"].encode()), r["next_text"], tree(r["next_text"].encode()))
            yield pa.RecordBatch.from_pylist([row], _RESULT)


def fingerprint_pairs(documents: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, with likenesses."""
    rows = documents.select(F.col("doc_id").cast("bigint"), "text", F.xxhash64("text").alias("h"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("h").asc()]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order, F.col("text").asc_nulls_first()).select("doc_id", "text")
    found = materialize(rows.mapInArrow(_walk, f"{_RESULT_DDL}, part bigint, first_text string, last_text string, last_id bigint"), "pairs")
    # which task comes next: the window sees one number for each task, and the texts are joined by it
    ends = found.where("part IS NOT NULL").select("part", "last_id", "last_text", "first_text")
    after, every = W.orderBy("part"), W.orderBy("part").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    following = ends.select("part", F.coalesce(F.lead("part").over(after), F.first("part").over(every)).alias("next"))
    ends = ends.join(following, "part").select("next", "last_id", "last_text").join(ends.select(F.col("part").alias("next"), F.col("first_text").alias("next_text")), "next")
    return found.where("part IS NULL").select(*_RESULT.names).unionByName(ends.select("last_id", "last_text", "next_text").mapInArrow(_ends, _RESULT_DDL))


def fingerprint(documents: DataFrame) -> DataFrame:
    """(doc_id, root, sections): the tree of each document, paragraphs by their hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            trees = [tree((t or "").encode()) for t in batch.column("text").to_pylist()]
            sections = [[{"hash": s.hex(), "paragraphs": [p.hex() for p, _ in own]} for s, own in t[1]] for t in trees]
            kind = pa.list_(pa.struct([("hash", pa.string()), ("paragraphs", pa.list_(pa.string()))]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([t[0].hex() for t in trees]), pa.array(sections, kind)], ["doc_id", "root", "sections"])

    return documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, root string, sections array<struct<hash:string,paragraphs:array<string>>>")


def op6_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document, its edited text and its neighbour."""
    return fingerprint_pairs(table(spark, sf_dir, "documents"))
