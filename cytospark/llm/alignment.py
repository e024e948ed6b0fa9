"""Alignment of two tokenizers over a corpus: which tokens end together, how often pairs of tokens do, and how well each text keeps to the common pairs.

An Arrow pipeline in tasks, with counts merged by Spark:

1. A task cuts its texts into blocks. Text is split before spaces that follow a word; no token of either tokenizer reaches over such a place (`Pair` checks that of its
   vocabulary), so that each distinct piece of a block is tokenized once, and its token ids are taken for all its occurrences.
2. List flatten and parent indices give one row for each token, cumulative sums within documents give the byte at which it ends, and an Acero hash join
   on (document, end) gives the links: tokens of both sides that end at the same byte. Between such ends lie the groups.
3. `Table.group_by` counts a block's pairs, Spark sums these partial counts, and the sums go back to the blocks by a join on the pair. A block asks once
   for each of its pairs, however often it has them, and AQE may split the rows of frequent pairs: the counts are written first.

A text is tokenized once; only ids of links, as places in their block's list of pairs, are kept for the second step.

Contract of the query: A is byte_bpe_50k over a space and the text, B piece_bpe_32k over the text (it adds the space itself). `n_best` counts links whose pair has
the highest count among the pairs of its B token, ties included; `count_sum` sums the counts of the links' pairs; `groups_sha256` is of A's and B's ids by group.

Nulls and edge cases: null and empty texts, and texts whose tokens don't give back the text's bytes (U+2581, for one), have no tokens: zeros and an empty digest; each row
gives a row, also without doc_id or with one that others have; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, table, text_blocks

#: Where the vocabularies are; they are read on the driver and sent to the tasks (2 MB).
TOKENIZERS = "/opt/tokenizers"
#: Bytes of text in a block.
BLOCK = 1_500_000
#: Bytes of pieces that are encoded as one text.
CHUNK = 4096

_BLOCKS = "block bigint, doc_id array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, digest array<string>, n_links array<int>, links binary, pairs array<bigint>, times array<bigint>"


def _byte_of_symbol() -> dict[str, int]:
    """Byte-level BPE writes printable bytes as themselves and the others, in order, as the characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Pair:
    """Both tokenizers, from the contents of their files, and the bytes of their tokens."""

    def __init__(self, byte_bpe: bytes, piece_bpe: bytes):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_bpe.decode())
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=piece_bpe)
        symbols, vocab = _byte_of_symbol(), json.loads(byte_bpe)["model"]["vocab"]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        # a token that goes on with a space after a word would break the split into pieces
        assert not any("▁" in p.lstrip("▁") for p in pieces)
        a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            a_bytes[i] = bytes(symbols[c] for c in token) if all(c in symbols for c in token) else token.encode()
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.space = self.b.piece_to_id("▁")
        self.bytes = [pa.array(x, pa.large_binary()) for x in (a_bytes, b_bytes)]
        self.sizes = [np.array([len(t) for t in x], np.int64) for x in (a_bytes, b_bytes)]
        # ids as text, with each of the signs that may follow
        self.written = pa.array([f"{i}{sign}".encode() for i in range(max(len(a_bytes), len(b_bytes))) for sign in ",|;"], pa.large_binary())

    def encode(self, data: bytes, at: np.ndarray, alone: bool = False) -> list[pa.LargeListArray]:
        """Ids of the pieces of `data` from each bound to the next, by A and by B. All pieces begin with a space.

        Pieces are encoded one after the other in longer texts, where no token reaches from one to the next; those that `_joinable` doesn't know to be safe, alone.
        """
        blob, sizes = np.frombuffer(data, np.uint8), np.diff(at)
        joined = _joinable(blob, at) & (at[1:] // CHUNK == at[:-1] // CHUNK) if not alone else np.zeros(len(sizes), bool)
        last = np.flatnonzero(~joined)
        first = np.append(0, last + 1)[:-1]
        starts, stops = at[first], at[last + 1]
        texts = [data[x:y].decode() for x, y in zip(starts.tolist(), stops.tolist(), strict=True)]
        a = [e.ids for e in self.a.encode_batch(texts, add_special_tokens=False)]
        b = [ids if len(t) > 1 else [self.space] for ids, t in zip(self.b.encode([t[1:] for t in texts], num_threads=1), texts, strict=True)]
        out = []
        for ids, token_sizes in zip((a, b), self.sizes, strict=True):
            flat = np.fromiter(chain.from_iterable(ids), np.int32)
            counts = np.array([len(x) for x in ids])
            chunk = np.repeat(np.arange(len(ids)), counts)
            total = np.append(0, np.cumsum(token_sizes[flat]))
            begin = total[np.cumsum(counts) - counts]
            wrong = total[np.cumsum(counts)] - begin != stops - starts
            if (wrong & (last > first)).any():  # not the bytes that went in, so that pieces can't be told apart
                return self.encode(data, at, alone=True)
            ends = np.where(wrong[chunk], stops[chunk], starts[chunk] + total[1:] - begin[chunk])
            bounds = np.append(0, np.searchsorted(ends, at[1:], "right"))
            out.append(pa.LargeListArray.from_arrays(pa.array(bounds), pa.array(flat)))
        return out


@lru_cache(1)
def _pair(byte_bpe: bytes, piece_bpe: bytes) -> Pair:
    return Pair(byte_bpe, piece_bpe)


def load(folder: str = TOKENIZERS) -> tuple[bytes, bytes]:
    """The contents of the two vocabulary files."""
    return Path(folder, "byte_bpe_50k.json").read_bytes(), Path(folder, "piece_bpe_32k.model").read_bytes()


def _after_word(blob: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character before each place (over 1) is a visible one of ASCII or a letter of U+00C0 to U+07FF; neither tokenizer takes any of these for white space."""
    before, lead = blob[at - 1], blob[at - 2]
    return ((before > 0x20) & (before < 0x7F)) | ((before >= 0x80) & (lead >= 0xC3) & (lead <= 0xDF))


def _joinable(blob: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the next piece may follow each piece in one text: it ends with a word, and has no U+2581."""
    out = (np.diff(at) > 1) & _after_word(blob, at[1:])
    mark = np.flatnonzero((blob[:-2] == 0xE2) & (blob[1:-1] == 0x96) & (blob[2:] == 0x81))
    odd = np.unique(np.searchsorted(at, mark, "right") - 1)
    out[odd] = False
    out[np.maximum(odd - 1, 0)] = False
    out[-1:] = False
    return out


def _pieces(blob: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where pieces start in `blob`: at each document (a space), and before spaces after a word."""
    spaces = np.flatnonzero(blob[2:] == 0x20) + 2
    return np.union1d(spaces[_after_word(blob, spaces)], starts)


def _spelled(tokens: pa.LargeBinaryArray, bounds: np.ndarray) -> Iterator[memoryview]:
    """The joined bytes of the tokens from each bound to the next; an array that was taken has them one after the other."""
    _, at, data = tokens.buffers()
    cut = np.frombuffer(at, np.int64)[bounds].tolist()
    data = memoryview(data).cast("B") if data else memoryview(b"")  # bytes, not signed numbers
    return (data[x:y] for x, y in zip(cut[:-1], cut[1:], strict=True))


def tokens_of(pair: Pair, texts: list[bytes]) -> list[pa.LargeListArray]:
    """Token ids of each text, by A and by B; none for empty texts and those that the tokens don't give back."""
    full = [b" " + t if t else b"" for t in texts]
    sizes = np.array([len(t) for t in full], np.int64)
    ends = np.cumsum(sizes)
    data = b"".join(full)
    blob = np.frombuffer(data, np.uint8)
    if not len(blob):
        return [pa.array([[]] * len(texts), pa.large_list(pa.int32()))] * 2
    at = _pieces(blob, (ends - sizes)[sizes > 0])
    offsets = np.append(at, len(blob)).astype(np.int64)
    pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
    words = pa.concat_arrays([pieces.dictionary])
    bounds = np.frombuffer(words.buffers()[1], np.int64)[: len(words) + 1]
    ids = pair.encode(words.buffers()[2].to_pybytes()[: bounds[-1]], bounds)
    of_doc = np.searchsorted(at, np.append(ends - sizes, len(blob)))  # the first piece of each document
    out = []
    for own, vocabulary in zip(ids, pair.bytes, strict=True):
        every = own.take(pieces.indices)
        flat, bounds = every.flatten(), every.offsets.to_numpy() - every.offsets[0].as_py()
        out.append((flat, bounds[of_doc], vocabulary))
    keep = sizes > 0
    for flat, bounds, vocabulary in out:
        keep &= [x == y for x, y in zip(_spelled(vocabulary.take(flat), bounds), full, strict=True)]
    return [pa.LargeListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.where(keep, np.diff(bounds), 0)))), flat.filter(pa.array(np.repeat(keep, np.diff(bounds))))) for flat, bounds, _ in out]


def ends_of(tokens: pa.LargeListArray, sizes: np.ndarray, name: str) -> pa.Table:
    """(doc, end, id, place) of each token: its document, the byte of the document at which it ends, its id and its place among all tokens."""
    flat, doc = tokens.flatten(), pc.list_parent_indices(tokens)
    total = np.append(0, np.cumsum(sizes[flat.to_numpy()]))
    base = total[tokens.offsets.to_numpy()[:-1]][doc.to_numpy()]
    return pa.table({"doc": doc, "end": pa.array(total[1:] - base), name: flat, f"{name}_at": pa.array(np.arange(len(flat)))})


def links_of(pair: Pair, tokens: list[pa.LargeListArray]) -> pa.Table:
    """(doc, end, a, b, a_at, b_at) of the links of a block, in the order of the text."""
    left, right = (ends_of(t, s, n) for t, s, n in zip(tokens, pair.sizes, "ab", strict=True))
    return left.join(right, ["doc", "end"], join_type="inner", use_threads=False).sort_by("a_at").combine_chunks()


def _digests(pair: Pair, tokens: list[pa.LargeListArray], links: pa.Table) -> list[str]:
    """Digest of each document's groups, written as `a1,a2|b1;a3|b2,b3`."""
    a, b = (t.flatten().to_numpy() for t in tokens)
    bounds = [t.offsets.to_numpy() for t in tokens]
    a_last, b_last = links["a_at"].to_numpy(), links["b_at"].to_numpy()
    # a group's A ids are followed by its B ids: each token moves by the tokens of the other side that come first
    group_of_a, group_of_b = np.searchsorted(a_last, np.arange(len(a))), np.searchsorted(b_last, np.arange(len(b)))
    a_to = np.arange(len(a)) + np.append(0, b_last + 1)[group_of_a]
    b_to = np.arange(len(b)) + (a_last + 1)[group_of_b]
    written = np.empty(len(a) + len(b), np.int64)
    sign = np.zeros(len(a), np.int64)
    sign[a_last] = 1
    written[a_to] = a * np.int64(3) + sign
    sign = np.zeros(len(b), np.int64)
    sign[b_last] = 2
    written[b_to] = b * np.int64(3) + sign
    return [hashlib.sha256(x[:-1]).hexdigest() if len(x) else "" for x in _spelled(pair.written.take(pa.array(written)), bounds[0] + bounds[1])]


def _lists(*columns: np.ndarray | list, types: list[pa.DataType]) -> list[pa.Array]:
    """Each column as the single list of a row."""
    return [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), pa.array(c, t)) for c, t in zip(columns, types, strict=True)]


def _code(pairs: int) -> str:
    """How a place in a list of so many pairs is packed."""
    return "<u2" if pairs <= 1 << 16 else "<u4"


def _align(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, block = _pair(*sent.value), TaskContext.get().partitionId() << 33
        for batch, texts in text_blocks(batches, limit=BLOCK):
            tokens = tokens_of(pair, texts)
            links = links_of(pair, tokens)
            n_links = np.bincount(links["doc"].to_numpy(), minlength=len(texts))
            key = pc.bit_wise_or(pc.shift_left(links["a"].cast(pa.int64()), 32), links["b"].cast(pa.int64())).combine_chunks()
            codes = key.dictionary_encode()
            counts = pa.table({"code": codes.indices}).group_by("code", use_threads=False).aggregate([([], "count_all")]).sort_by("code")
            sizes = [t.value_lengths().to_numpy() for t in tokens]
            long = pa.int64()
            columns = _lists(batch.column("doc_id"), *sizes, n_links, _digests(pair, tokens, links), n_links, codes.dictionary, counts["count_all"].combine_chunks(), types=[long, long, long, long, pa.string(), pa.int32(), long, long])
            packed = pa.array([codes.indices.to_numpy().astype(_code(len(codes.dictionary))).tobytes()], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([block], long), *columns[:6], packed, *columns[6:]], ["block", "doc_id", "n_a", "n_b", "n_groups", "digest", "n_links", "links", "pairs", "times"])
            block += 1

    return run


def align(documents: DataFrame, tokenizers: tuple[bytes, bytes]) -> DataFrame:
    """A row for each block of documents: their figures, their links as packed places in the block's `pairs` (A's id << 32 | B's id), and how often it has each. Written out."""
    sent = documents.sparkSession.sparkContext.broadcast(tokenizers)
    return materialize(documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(_align(sent), _BLOCKS), "blocks")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, a, b, count, best): how many links of the corpus have the pair, and whether no pair of its B token has more. Written out."""
    counts = blocks.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.times").alias("count"))
    counts = materialize(counts.withColumn("a", F.shiftright("pair", 32).cast("int")).withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")), "counts")
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return materialize(counts.join(most, "b").select("pair", "a", "b", "count", (F.col("count") == F.col("most")).alias("best")), "counts")


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of documents from rows of blocks and the counts of their pairs."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: batch.column(n)[i].values for n in ("doc_id", "n_a", "n_b", "n_groups", "digest", "n_links")}
            n, pairs = row["n_links"].to_numpy(), batch.column("n_pairs")[i].as_py()
            links = np.frombuffer(batch.column("links")[i].as_buffer(), _code(pairs))
            count, best = np.zeros(pairs, np.int64), np.zeros(pairs, np.int64)
            if (replies := batch.column("replies")[i]).is_valid:
                code = replies.values.field("code").to_numpy()
                count[code] = replies.values.field("count").to_numpy()
                best[code] = replies.values.field("best").to_numpy(zero_copy_only=False)
            ends = np.append(0, np.cumsum(n))
            total = [np.append(0, np.cumsum(x[links]))[ends] for x in (best, count)]
            yield pa.RecordBatch.from_arrays([row["doc_id"], row["n_a"], row["n_b"], row["n_groups"], row["n_links"].cast(pa.int64()), *[pa.array(np.diff(t)) for t in total], row["digest"]], ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


def documents_of(blocks: DataFrame, counts: DataFrame) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each document."""
    asked = blocks.select("block", F.posexplode("pairs").alias("code", "pair"))
    replies = asked.join(counts.select("pair", "count", "best"), "pair").groupBy("block").agg(F.collect_list(F.struct("code", "count", "best")).alias("replies"))
    joined = blocks.select("block", "doc_id", "n_a", "n_b", "n_groups", "digest", "n_links", "links", F.size("pairs").alias("n_pairs")).join(replies, "block", "left")
    return joined.mapInArrow(_sums, "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string")


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens, groups, links and how common they are, for every document."""
    blocks = align(table(spark, sf_dir, "documents"), load())
    return documents_of(blocks, pair_counts(blocks))
