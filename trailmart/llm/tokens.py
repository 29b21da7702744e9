"""Encoding texts by a public byte-level BPE vocabulary.

Texts are cut into words inside the JVM by the vocabulary's pattern. The words of the whole corpus are
counted, and the most frequent ones are compiled, with their ids, into a minimal acyclic automaton
(lexicon.py) that every worker maps into memory. A batch's distinct words walk it together; the words
it lacks are merged exactly, all at once, one merge of each word a step.

The vocabulary's tables have a fixed size (about 50,000 merges), and the lexicon at most ``LEXICON``
words, so both may be sent to every worker.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmart.llm.lexicon import Lexicon, build
from trailmart.session import checkpoint_folder, checkpointed

#: Bound on the words of the lexicon, and on a word's bytes; rarer or longer words are merged.
LEXICON = 1 << 15
LONGEST = 32
BINS = 32
#: Words of more bytes are merged one by one with a heap.
LONG_WORD = 256
TOKENIZERS = "/opt/tokenizers"

# Fixed value: the vocabulary's published splitting pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Unicode's white space, written out, as Java's \s is ASCII only.
SPACE = r"\x09-\x0d\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
JAVA_PATTERN = PATTERN.replace(r"[^\s\p{L}", rf"[^{SPACE}\p{{L}}").replace(r"\s+(?!\S)|\s+", rf"[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for.

    Printable Latin-1 characters stand for themselves, the other bytes, in order, for the letters
    from U+0100 on.
    """
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Merger:
    """Exact byte-pair merges with the ranks of a vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        letters, vocab = byte_letters(), model["vocab"]
        self.byte_ids = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.byte_ids[byte] = vocab[letter]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.rank_of = {int(k): r for r, k in enumerate(keys)}
        self.made_by_rank = made
        # open addressing: a slot holds a key and its rank
        self.bits = (2 * len(keys)).bit_length() + 1
        self.table = np.full(1 << self.bits, -1, np.int64)
        self.rank = np.full(1 << self.bits, 1 << 30, np.int64)
        slots = self._slot(keys[order])
        todo, ranks = keys[order], order.astype(np.int64)
        self.probes = 0
        while len(todo):
            free = self.table[slots] == -1
            _, first = np.unique(slots, return_index=True)
            chosen = np.zeros(len(todo), bool)
            chosen[first] = True
            chosen &= free
            self.table[slots[chosen]], self.rank[slots[chosen]] = todo[chosen], ranks[chosen]
            todo, ranks, slots = todo[~chosen], ranks[~chosen], (slots[~chosen] + 1) & ((1 << self.bits) - 1)
            self.probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ranks of pairs of ids; 2^30 for pairs that never merge."""
        keys = left << 20 | right
        slots = self._slot(keys)
        held = self.table[slots]
        out = np.where(held == keys, self.rank[slots], 1 << 30)
        open_ = np.flatnonzero((held != keys) & (held != -1))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & ((1 << self.bits) - 1)
            held = self.table[slots[open_]]
            hit = held == keys[open_]
            out[open_[hit]] = self.rank[slots[open_[hit]]]
            open_ = open_[~hit & (held != -1)]
        return out

    def merge_long(self, word: bytes) -> list[int]:
        """The ids of one word, in time near to its length."""
        ids: list[int] = self.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        size = len(ids)
        before, after, rank_of = list(range(-1, size - 1)), list(range(1, size + 1)), self.rank_of
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(size - 1) if (r := rank_of.get(ids[i] << 20 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= size or ids[j] != b:
                continue
            ids[i], ids[j] = int(self.made_by_rank[rank]), -1
            after[i] = after[j]
            if after[i] < size:
                before[after[i]] = i
                if (r := rank_of.get(ids[i] << 20 | ids[after[i]])) is not None:
                    heapq.heappush(heap, (r, i, ids[i], ids[after[i]]))
            if (k := before[i]) >= 0 and (r := rank_of.get(ids[k] << 20 | ids[i])) is not None:
                heapq.heappush(heap, (r, k, ids[k], ids[i]))
        return [x for x in ids if x >= 0]

    def merge_all(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many words in one array, and each word's number of ids.

        All words take a step together: in each, every occurrence of its pair of least rank merges,
        from left to right. Words that cannot merge further leave the race.
        """
        size = len(starts)
        counts = np.zeros(size, np.int64)
        pieces: list[tuple[np.ndarray, np.ndarray]] = []  # owners, ids
        long_words = np.flatnonzero(lengths > LONG_WORD)
        for w in long_words.tolist():
            ids = np.array(self.merge_long(data[starts[w] : starts[w] + lengths[w]].tobytes()), np.int64)
            pieces.append((np.full(len(ids), w), ids))
        short = np.flatnonzero((lengths <= LONG_WORD) & (lengths > 0))
        owner = np.repeat(short, lengths[short])
        first = np.cumsum(lengths[short]) - lengths[short]
        ids = self.byte_ids[data[np.repeat(starts[short] - first, lengths[short]) + np.arange(len(owner))]]
        rank = np.full(len(ids), 1 << 30, np.int64)
        if len(ids) > 1:
            rank[:-1] = np.where(owner[:-1] == owner[1:], self.ranks(ids[:-1], ids[1:]), 1 << 30)
        while len(ids):
            heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            spans = np.diff(np.r_[heads, len(ids)])
            least = np.minimum.reduceat(rank, heads)
            running = least < 1 << 30
            if not running.all():
                stays = np.repeat(running, spans)
                pieces.append((owner[~stays], ids[~stays]))
                owner, ids, rank = owner[stays], ids[stays], rank[stays]
                spans, least = spans[running], least[running]
                if not len(ids):
                    break
            hit = rank == np.repeat(least, spans)
            # of overlapping occurrences (aaa), every second one counted from the run's start merges
            at = np.flatnonzero(hit)
            run = np.r_[True, np.diff(at) > 1]
            begin = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - begin) % 2 == 0]
            ids[at] = self.made_by_rank[rank[at]]
            alive = np.ones(len(ids), bool)
            alive[at + 1] = False
            place = np.cumsum(alive) - 1
            changed = place[at]
            owner, ids, rank = owner[alive], ids[alive], rank[alive]
            again = np.unique(np.r_[changed, changed - 1])
            again = again[again >= 0]
            rank[again] = 1 << 30
            inner = again[again < len(ids) - 1]
            inner = inner[owner[inner] == owner[inner + 1]]
            rank[inner] = self.ranks(ids[inner], ids[inner + 1])
        if not pieces:
            return np.empty(0, np.int64), counts
        owners = np.concatenate([p[0] for p in pieces])
        flat = np.concatenate([p[1] for p in pieces])
        order = np.argsort(owners, kind="stable")
        counts += np.bincount(owners, minlength=size)
        return flat[order], counts


@lru_cache(maxsize=2)
def merger(path: str) -> Merger:
    return Merger(path)


@lru_cache(maxsize=2)
def _lexicon(name: str) -> Lexicon:
    return Lexicon(SparkFiles.get(name))


def vocabulary(folder: str = TOKENIZERS, name: str = "byte_bpe_50k") -> str:
    return os.path.join(folder, f"{name}.json")


def words(text: str = "text"):
    """The words of a text as an array; the pattern runs in the JVM."""
    return F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(JAVA_PATTERN), F.lit(0))


def frequent_words(df: DataFrame, text: str = "text", limit: int = LEXICON) -> list[str]:
    """The most frequent words of all texts, at most ``limit``.

    The counts are binned by size (at most 64 x BINS bins) to find how frequent a word must be, so that
    no more than ``limit`` words, and no candidates, come to the driver. The lexicon only saves time:
    which words it has changes no result.
    """
    counted = df.select(F.explode(words(text)).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    counted = checkpointed(
        counted.where((F.octet_length("word") <= LONGEST) & (F.col("n") > 1)).select("word", F.floor(F.log2("n") * BINS).cast("int").alias("bin"))
    )
    sizes = sorted(((r[0], r[1]) for r in counted.groupBy("bin").agg(F.count("*")).collect()), reverse=True)
    taken, least = 0, None
    for bin_, size in sizes:
        if taken + size > limit:
            break
        taken, least = taken + size, bin_
    return [] if least is None else [r[0] for r in counted.where(F.col("bin") >= least).select("word").collect()]


def _flat(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = np.array([len(t) for t in texts], np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum(lengths) - lengths, lengths


def ship_lexicon(df: DataFrame, vocab: str, text: str = "text", limit: int = LEXICON) -> str:
    """Compile the frequent words of ``df`` and send the file to all workers; returns its name."""
    chosen = sorted({w.encode() for w in frequent_words(df, text, limit)})
    flat, counts = merger(vocab).merge_all(*_flat(chosen)) if chosen else (np.empty(0, np.int64), np.empty(0, np.int64))
    ends = np.cumsum(counts)
    data = build(chosen, {w: flat[e - c : e].tolist() for w, c, e in zip(chosen, counts, ends, strict=True)})
    name = f"lexicon-{hashlib.sha256(data).hexdigest()[:24]}.bin"
    context = df.sparkSession.sparkContext
    if name not in {os.path.basename(f) for f in context.listFiles}:
        context.addFile(_stored(df, name, data))
    return name


def _stored(df: DataFrame, name: str, data: bytes) -> str:
    """Write a file beside the application's checkpoints, with which it is removed."""
    context = df.sparkSession.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_folder(df.sparkSession)}/{name}")
    stream = path.getFileSystem(context._jsc.hadoopConfiguration()).create(path, True)
    stream.write(bytearray(data))
    stream.close()
    return path.toString()


def _batch_ids(column: pa.Array, lexicon: Lexicon, merge: Merger) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and ids of the texts of one batch of word arrays."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    pieces = column.values.slice(offsets[0], offsets[-1] - offsets[0])
    offsets = offsets - offsets[0]
    coded = pieces.dictionary_encode()
    known = coded.dictionary.cast(pa.large_binary())
    places = np.frombuffer(known.buffers()[1], np.int64)[known.offset : known.offset + len(known) + 1]
    data = np.frombuffer(known.buffers()[2] or b"", np.uint8)
    starts, lengths = places[:-1], np.diff(places)
    number = lexicon.find(data, starts, lengths)
    missing = np.flatnonzero(number < 0)
    merged, counts = merge.merge_all(data, starts[missing], lengths[missing])
    table = np.concatenate([lexicon.ids.astype(np.int64), merged])
    first, size = np.zeros(len(known), np.int64), np.zeros(len(known), np.int64)
    seen = number >= 0
    first[seen] = lexicon.offsets[number[seen]]
    size[seen] = lexicon.offsets[number[seen] + 1] - lexicon.offsets[number[seen]]
    first[missing], size[missing] = len(lexicon.ids) + np.cumsum(counts) - counts, counts
    word = coded.indices.to_numpy()
    sizes = size[word]
    ends = np.r_[0, np.cumsum(sizes)]
    return ends[offsets], table[np.repeat(first[word] - ends[:-1], sizes) + np.arange(ends[-1])]


def _rare(df: DataFrame, text: str):
    """Texts with characters this JVM's Unicode version does not know; Python may know them better."""
    return F.coalesce(F.col(text).rlike(r"\p{Cn}"), F.lit(False))


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", folder: str = TOKENIZERS, limit: int = LEXICON, only_counts: bool = False) -> DataFrame:
    """One row per document: its key and ``ids`` (or ``tokens``, their number, if ``only_counts``).

    No special tokens; their strings in a text are ordinary text. A null or empty text has an empty
    list. Repeated keys keep a row each; other columns are ignored. An empty table gives no rows.
    """
    vocab = vocabulary(folder)
    name = ship_lexicon(df, vocab, text, limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, merge = _lexicon(name), merger(vocab)
        split = None
        for batch in batches:
            column = batch.column(1)
            rare = batch.column(2)
            if pc.any(rare.is_valid()).as_py():
                if split is None:
                    import regex

                    split = regex.compile(PATTERN).findall
                column = pa.array([split(r) if r is not None else w for w, r in zip(column.to_pylist(), rare.to_pylist(), strict=True)], pa.list_(pa.string()))
            offsets, ids = _batch_ids(column, lexicon, merge)
            if only_counts:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offsets))], ["doc", "tokens"])
            else:
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["doc", "ids"])

    rows = df.select(F.col(key).cast("bigint").alias("doc"), F.when(_rare(df, text), F.array().cast("array<string>")).otherwise(words(text)).alias("words"), F.when(_rare(df, text), F.col(text)).alias("rare"))
    made = rows.mapInArrow(run, f"doc bigint, {'tokens bigint' if only_counts else 'ids array<int>'}")
    return made.withColumnRenamed("doc", key)


def decode(df: DataFrame, key: str = "doc_id", folder: str = TOKENIZERS) -> DataFrame:
    """The way back: key and text of rows with ``ids``; bytes that are no UTF-8 are replaced, as by the public tokenizer."""
    vocab = vocabulary(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = byte_letters()
        with open(vocab, encoding="utf-8") as file:
            known = json.load(file)["model"]["vocab"]
        pieces = {i: bytes(letters[c] for c in token) for token, i in known.items() if all(c in letters for c in token)}
        for batch in batches:
            texts = [b"".join(pieces[i] for i in ids or ()).decode("utf-8", "replace") for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc", "text"])

    return df.select(F.col(key).cast("bigint").alias("doc"), "ids").mapInArrow(run, "doc bigint, text string").withColumnRenamed("doc", key)
