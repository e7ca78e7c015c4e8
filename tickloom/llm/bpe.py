"""BPE encoding and decoding: a minimal acyclic transducer for frequent words, exact merges for the rest."""

from __future__ import annotations

import hashlib
import json
import mmap
import re
import struct
import unicodedata
from array import array
from collections import Counter
from collections.abc import Iterable
from functools import lru_cache
from itertools import compress

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import byte_slices, held_bytes, written
from tickloom.session import scratch_dir

LEXICON_WORDS = 150_000
MAX_WORD_BYTES = 64
CACHE_BYTES = 56 << 20
COUNTED = 300_000
PART_BYTES = 1 << 20
NO_MERGE = 1 << 31  # above every rank


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte: itself if printable in Latin-1, else the next free code point from 256."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Merges:
    """A BPE vocabulary with a word-end mark: exact merging of one word, and strings by id."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        self.pattern = regex.compile(
            next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        )
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.strings = [""] * (1 + max([*vocab.values(), *self.special.values()]))
        for token, i in [*vocab.items(), *self.special.items()]:
            self.strings[i] = token
        self.alphabet = byte_alphabet()
        self.inner = [vocab[c] for c in self.alphabet]
        self.last = [vocab[c + self.end] for c in self.alphabet]
        self.ranks: dict[tuple[int, int], int] = {}
        self.results: list[int] = []  # by rank
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks.setdefault((vocab[left], vocab[right]), rank)
            self.results.append(vocab[left + right])
        # the ranks of a word's own pairs of bytes, by both bytes; the last pair ends the word
        self.starts = [[self.ranks.get((a, b), NO_MERGE) for b in self.inner] for a in self.inner]
        self.ends = [[self.ranks.get((a, b), NO_MERGE) for b in self.last] for a in self.inner]

    def merge(self, word: bytes) -> list[int]:
        """Ids of a word: the adjacent pair of lowest rank merges first, the leftmost of equals.

        The ranks of all pairs are kept; a merge changes those of its two neighbours.
        """
        ids = [self.inner[b] for b in word]
        ids[-1] = self.last[word[-1]]
        if len(ids) > 256:
            return self.merge_long(ids)
        ranks, results = self.ranks.get, self.results
        starts = self.starts
        found = [starts[a][b] for a, b in zip(word, word[1:], strict=False)]
        if found:
            found[-1] = self.ends[word[-2]][word[-1]]
        while found and (best := min(found)) < NO_MERGE:
            at = found.index(best)
            ids[at] = results[best]
            del ids[at + 1], found[at]
            if at:
                found[at - 1] = ranks((ids[at - 1], ids[at]), NO_MERGE)
            if at < len(found):
                found[at] = ranks((ids[at], ids[at + 1]), NO_MERGE)
        return ids

    def merge_long(self, ids: list[int]) -> list[int]:
        """The same through a heap over linked symbols, for words of any length."""
        import heapq

        n = len(ids)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        rank = self.ranks.get
        heap = [(f, i, ids[i], ids[i + 1]) for i in range(n - 1) if (f := rank((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j < 0 or ids[j] != right:
                continue
            ids[i], ids[j], after[i] = self.results[self.ranks[left, right]], -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
                if (f := rank((ids[i], ids[after[i]]))) is not None:
                    heapq.heappush(heap, (f, i, ids[i], ids[after[i]]))
            if before[i] >= 0 and (f := rank((ids[before[i]], ids[i]))) is not None:
                heapq.heappush(heap, (f, before[i], ids[before[i]], ids[i]))
        return [x for x in ids if x >= 0]

    def segments(self, text: str):
        """Ordinary stretches of a text and the ids of special strings between them."""
        at = 0
        for found in self.cut.finditer(text):
            yield text[at : found.start()], self.special[found[0]]
            at = found.end()
        yield text[at:], None

    def words(self, stretch: str) -> list[bytes]:
        """Words of a stretch, normalised and lower-cased code point by code point."""
        return [w.encode() for w in self.cut_words(self.folded(stretch))]

    def folded(self, text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def cut_words(self, folded: str) -> list[str]:
        if folded.isalpha():  # letters alone are one word
            return [folded]
        if folded[-1:] in (".", ",") and folded[:-1].isalpha():
            return [folded[:-1], folded[-1:]]
        return self.pattern.findall(folded)

    def words_of(self, chunks: list[str]) -> tuple[list[str], list[str], dict[str, list[str]]]:
        """The chunks that are one word, these words, and the words of each other chunk.

        Chunks hold no line end, and nothing is normalised or folded across one, so all are folded in one run.
        """
        if not chunks:
            return [], [], {}
        folded = self.folded("\n".join(chunks)).split("\n")
        alone = list(map(str.isalpha, folded))
        cut = self.cut_words
        several = {chunk: cut(f) for chunk, f, is_word in zip(chunks, folded, alone, strict=True) if not is_word}
        return list(compress(chunks, alone)), list(compress(folded, alone)), several


@lru_cache(maxsize=2)
def merges_of(path: str) -> Merges:
    """The merges of a file, kept between the tasks of a Python worker."""
    return Merges(path)


class Transducer:
    """A minimal acyclic automaton with numbers of words as outputs, and the id list of each number.

    Arcs lie in arrays, one row per state and byte class; the number of a word is the sum of the skip counts on its
    path, so shared suffixes stay shared. The file is mapped, not read.
    """

    MAGIC = b"MAFST1\0\0"

    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            data = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        states, classes, words, ids = struct.unpack_from("<4q", data, 8)
        at = 40

        def take(dtype, *shape):
            nonlocal at
            n = int(np.prod(shape))
            found = np.frombuffer(data, dtype, n, at).reshape(shape)
            at += found.nbytes
            return found

        self.next = take(np.int32, states, classes)
        self.skip = take(np.int32, states, classes)
        self.final = take(np.int32, states)
        self.starts = memoryview(take(np.int32, words + 1))  # its items are plain numbers
        self.ids = memoryview(take(np.uint32, ids))
        self.classes = take(np.uint8, 256)

    @classmethod
    def compile(cls, entries: list[tuple[bytes, list[int]]]) -> bytes:
        """The file of a transducer over sorted distinct words."""
        used = sorted({b for word, _ in entries for b in word})
        of = np.zeros(256, np.uint8)  # class 0: a byte no word has
        for i, b in enumerate(used):
            of[b] = i + 1
        register: dict[tuple, int] = {}
        arcs: list[tuple] = []
        finals: list[bool] = []

        def freeze(node) -> int:
            key = (node[0], tuple(node[1].items()))
            at = register.get(key)
            if at is None:
                at = register[key] = len(arcs)
                arcs.append(key[1])
                finals.append(node[0])
            return at

        path: list[list] = [[False, {}]]  # states of the last word that may still change
        previous = b""

        def close(depth: int) -> None:
            while len(path) - 1 > depth:
                node = path.pop()
                path[-1][1][previous[len(path) - 1]] = freeze(node)

        for word, _ in entries:
            shared = 0
            while shared < min(len(word), len(previous)) and word[shared] == previous[shared]:
                shared += 1
            close(shared)
            previous = word
            path.extend([False, {}] for _ in word[shared:])
            path[-1][0] = True
        close(0)
        root = freeze(path[0])
        states, classes = len(arcs), len(used) + 1
        following = np.full((states, classes), -1, np.int32)
        skip = np.zeros((states, classes), np.int32)
        final = np.array(finals, np.int32)
        below = [0] * states
        for i in range(states):  # states are frozen after all states they lead to
            passed = int(finals[i])
            for b, to in sorted(arcs[i]):
                following[i, of[b]], skip[i, of[b]] = to, passed
                passed += below[to]
            below[i] = passed
        order = np.arange(states)
        order[[root, 0]] = order[[0, root]]  # the root becomes state 0
        renamed = np.where(following >= 0, order[following], -1).astype(np.int32)[order]
        lists = [ids for _, ids in entries]
        starts = np.cumsum([0, *map(len, lists)]).astype(np.int32)
        flat = np.array([x for ids in lists for x in ids], np.uint32)
        head = cls.MAGIC + struct.pack("<4q", states, classes, len(entries), len(flat))
        parts = (renamed, skip[order], final[order], starts, flat, of)
        return head + b"".join(np.ascontiguousarray(p).tobytes() for p in parts)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 for an unseen one; all words step through the automaton together."""
        found = np.full(len(words), -1, np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.flatnonzero((sizes > 0) & (sizes <= MAX_WORD_BYTES))
        if not len(order):
            return found
        order = order[np.argsort(-sizes[order], kind="stable")]
        ordered = sizes[order]
        codes = np.frombuffer(b"".join(words[i] for i in order), np.uint8)
        codes = self.classes[codes].astype(np.int64)
        starts = np.cumsum(ordered) - ordered
        state, total = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        for t in range(int(ordered[0])):
            k = int(np.searchsorted(-ordered, -t, side="left"))  # words longer than t
            code, live = codes[starts[:k] + t], state[:k] >= 0
            at = np.where(live, state[:k], 0)
            total[:k] += self.skip[at, code]
            state[:k] = np.where(live, self.next[at, code], -1)
        good = (state >= 0) & (self.final[np.maximum(state, 0)] > 0)
        found[order[good]] = total[good]
        return found

    def ids_of(self, number: int) -> bytes:
        return self.ids[self.starts[number] : self.starts[number + 1]].tobytes()


class Codec:
    """Texts to little-endian ids and back; each distinct stretch between white space once while it is cached.

    The cache has two generations: when the new one has CACHE_BYTES it becomes the old one, and what is met again moves
    back.
    """

    def __init__(self, merges: Merges, lexicon: Transducer) -> None:
        self.merges, self.lexicon = merges, lexicon
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    def learn(self, chunks) -> None:
        """Encode chunks: their words go through the transducer together, those it lacks are merged."""
        alone, their, several = self.merges.words_of(list(chunks))
        words = set(their).union(*several.values())
        coded = [word.encode() for word in words]
        merge, ids_of = self.merges.merge, self.lexicon.ids_of
        numbers = self.lexicon.numbers(coded).tolist()
        ids = [ids_of(n) if n >= 0 else array("I", merge(w)).tobytes() for w, n in zip(coded, numbers, strict=True)]
        own = dict(zip(words, ids, strict=True)).__getitem__
        found = list(map(own, their))
        self.known.update(zip(alone, found, strict=True))
        self.held += sum(map(len, found))
        found = [b"".join(map(own, parts)) for parts in several.values()]
        self.known.update(zip(several, found, strict=True))
        self.held += sum(map(len, found))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers; NULL is encoded as empty."""
        cut: list[list[list[str] | int]] = []
        for text in texts:
            parts: list[list[str] | int] = []
            for stretch, special in self.merges.segments(text or ""):
                parts.append(chunks_of(stretch))
                if special is not None:
                    parts.append(special)
            cut.append(parts)
        if self.held > CACHE_BYTES:
            self.known, self.old, self.held = {}, self.known, 0
        wanted = set().union(*(p for parts in cut for p in parts if not isinstance(p, int))).difference(self.known)
        met = wanted.intersection(self.old)
        self.known.update(zip(met, map(self.old.__getitem__, met), strict=True))
        self.learn(wanted - met)
        self.held += held_bytes(wanted) + sum([len(self.old[c]) for c in met])
        known = self.known.__getitem__
        return [
            b"".join(struct.pack("<I", p) if isinstance(p, int) else b"".join(map(known, p)) for p in parts) for parts in cut
        ]

    def decode(self, ids: bytes) -> str:
        """What the vocabulary file's library makes of ids without a decoder: their strings, joined by a space."""
        return " ".join(map(self.merges.strings.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_ODD_SPACE = re.compile("[\x1c-\x1f]")
_SPACE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def chunks_of(stretch: str) -> list[str]:
    """Parts between white space; no word crosses it. Four control codes are no white space for the tokenizer."""
    if _ODD_SPACE.search(stretch):
        return [x for x in _SPACE.split(stretch) if x]
    return stretch.split()


def frequent_words(docs: DataFrame, tokenizer: str, limit: int) -> DataFrame:
    """(word) of the most frequent words over all documents, about ``limit`` at most; words met once are left out.

    Of equally frequent words at the end those whose hashes are lowest stay. The driver sees how many words there are
    of each frequency, not the words.
    """

    def count(batches):
        merges = merges_of(tokenizer)

        def emit(found: Counter):
            alone, their, several = merges.words_of(list(found))
            words = dict.fromkeys(their, 0)
            for chunk, word in zip(alone, their, strict=True):
                words[word] += found[chunk]
            for chunk, parts in several.items():
                for word in parts:
                    words[word] = words.get(word, 0) + found[chunk]
            counted = {code: n for word, n in words.items() if len(code := word.encode()) <= MAX_WORD_BYTES}
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counted), pa.binary()), pa.array(list(counted.values()), pa.int64())], ["word", "n"]
            )

        found: Counter[str] = Counter()
        for batch in byte_slices(batches):
            for text in batch.column(0).to_pylist():
                if text:
                    found.update(chunks_of(text))
            if len(found) > COUNTED:
                yield emit(found)
                found = Counter()
        yield emit(found)

    counted = docs.select("text").mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    counted = written(counted.where("n > 1"), "words")
    sizes = counted.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).toArrow()
    often, words = sizes["n"].to_numpy(), sizes["words"].to_numpy()
    total = np.cumsum(words)
    whole = int(np.searchsorted(total, limit, side="right"))  # frequencies all of whose words stay
    if whole < len(total):
        least, rest = int(often[whole]), limit - (int(total[whole - 1]) if whole else 0)
        first = F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < (1 << 30) * rest // int(words[whole])
        counted = counted.where((F.col("n") > least) | ((F.col("n") == least) & first))
    return counted.select("word")


def publish(spark: SparkSession, parts: Iterable[bytes], name: str) -> str:
    """Write a file to the shared folder and have Spark fetch it to every executor; returns its name."""
    folder = scratch_dir(spark, name)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{folder.rsplit('/', 1)[-1]}.bin")
    stream = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    try:
        for part in parts:
            stream.write(bytearray(part))
    finally:
        stream.close()
    spark.sparkContext.addFile(path.toString())
    return path.getName()


def build_lexicon(docs: DataFrame, tokenizer: str, limit: int = LEXICON_WORDS) -> str:
    """Compile the corpus's frequent words with their ids; returns the name of the published file.

    One task compiles them, as ``limit`` bounds their number; the file passes through the driver in small parts.
    """

    def compiled(batches):
        merges = merges_of(tokenizer)
        words = sorted(word for batch in batches for word in batch.column(0).to_pylist())
        data = Transducer.compile([(w, merges.merge(w)) for w in words])
        for at in range(0, len(data), PART_BYTES):
            yield pa.RecordBatch.from_arrays([pa.array([data[at : at + PART_BYTES]], pa.binary())], ["part"])

    parts = frequent_words(docs, tokenizer, limit).coalesce(1).mapInArrow(compiled, "part binary")
    return publish(docs.sparkSession, (r.part for r in parts.toLocalIterator()), "lexicon")


def bpe_round_trip(
    docs: DataFrame, tokenizer: str, lexicon_words: int = LEXICON_WORDS, keep_ids: bool = False, pack_ids: bool = False
) -> DataFrame:
    """Encode every whole text and decode its ids.

    Columns: ``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``, and with ``keep_ids`` also ``ids`` and
    ``decoded``; with ``pack_ids`` also ``packed_ids``, the bytes that ``ids_sha256`` digests: little-endian unsigned
    32-bit integers, less to copy and write than an array. The result does not depend on ``lexicon_words``, which only decides what the transducer holds. One row
    per input row. A NULL text counts as empty: no ids, the digests of nothing. Special strings in a text become their
    ids. Only id and text are read.
    """
    lexicon = build_lexicon(docs, tokenizer, lexicon_words)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        codec = Codec(merges_of(tokenizer), Transducer(SparkFiles.get(lexicon)))
        for batch in byte_slices(batches, column=1):
            found = codec.encode(batch.column(1).to_pylist())
            decoded = [codec.decode(x) for x in found]
            digest = lambda x: hashlib.sha256(x).hexdigest()
            columns = {
                "doc_id": batch.column(0),
                "n_tokens": pa.array([len(x) // 4 for x in found], pa.int64()),
                "ids_sha256": pa.array([digest(x) for x in found], pa.string()),
                "decoded_sha256": pa.array([digest(x.encode()) for x in decoded], pa.string()),
            }
            if keep_ids:
                starts = np.cumsum([0, *[len(x) // 4 for x in found]], dtype=np.int64).astype(np.int32)
                every = pa.array(np.frombuffer(b"".join(found), "<u4").astype(np.int64))
                columns["ids"] = pa.ListArray.from_arrays(pa.array(starts), every)
                columns["decoded"] = pa.array(decoded, pa.string())
            if pack_ids:
                columns["packed_ids"] = pa.array(map(bytes, found), pa.binary())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    schema = f"doc_id {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<bigint>, decoded string" * keep_ids + ", packed_ids binary" * pack_ids
    return docs.select("doc_id", "text").mapInArrow(run, schema)
