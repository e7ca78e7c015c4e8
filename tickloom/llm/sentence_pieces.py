"""SentencePiece encoding and decoding: a table of each prefix's unique last piece, read backwards."""

from __future__ import annotations

import hashlib
import heapq
import operator
import re
from collections.abc import Iterable
from functools import lru_cache
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame

from tickloom.llm.common import byte_slices

MARK = "▁"  # stands for a space within pieces
CACHED_CHARS = 16 << 20
LONGEST_CACHED = 64
CACHED_PAIRS = 1_000_000
_RUNS = re.compile(" +[^ ]*")


def merged(parts: list[str], scores: dict[str, float]) -> tuple[list[str], tuple[str, str] | None]:
    """Merge neighbours whose joint string has a score, the highest first, the leftmost of equals; also the last merge."""
    parts, last = list(parts), None
    after, before = [*range(1, len(parts)), -1], [*range(-1, len(parts) - 1)]
    queue: list[tuple[float, int, int, str]] = []

    def offer(i: int, j: int) -> None:
        if i >= 0 and j >= 0 and (score := scores.get(parts[i] + parts[j])) is not None:
            heapq.heappush(queue, (-score, i, j, parts[i] + parts[j]))

    for i in range(len(parts) - 1):
        offer(i, i + 1)
    while queue:
        _, i, j, both = heapq.heappop(queue)
        if not parts[i] or after[i] != j or parts[i] + parts[j] != both:
            continue  # one of the two has changed since
        last = parts[i], parts[j]
        parts[i], parts[j] = both, ""
        after[i] = after[j]
        if after[i] >= 0:
            before[after[i]] = i
        offer(before[i], i)
        offer(i, after[i])
    return [p for p in parts if p], last


class Pieces:
    """What a BPE model file says, as plain tables that travel with a task.

    A piece is *proper* if its score lies below those of both parts of its own last merge, and these are proper. The
    others (in practice runs of spaces of one common score), and all that do not come before them, are merged late:
    after the merges of the proper ones.
    """

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.key = f"{path}:{size}"
        self.names = [model.id_to_piece(i) for i in range(size)]
        self.end = model.eos_id()
        self.unknown = model.unk_id()
        self.bytes = {int(self.names[i][1:-1], 16): i for i in range(size) if model.is_byte(i)}
        normal = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        self.ids = {self.names[i]: i for i in normal}
        if any(model.is_unused(i) for i in normal) or model.normalize("ﬁ  x ") != f"{MARK}ﬁ{MARK}{MARK}x{MARK}":
            raise ValueError("needs a model without unused pieces that keeps texts as they are")
        if len(self.bytes) != 256 or any(c not in self.ids for i in normal for c in self.names[i]):
            raise ValueError("needs byte pieces and a piece for every character")
        scores = {self.names[i]: model.get_score(i) for i in normal if len(self.names[i]) > 1}
        self.pairs = {p[k : k + 2] for p in scores for k in range(len(p) - 1)}
        if any(a != MARK and b == MARK for a, b in self.pairs):
            raise ValueError("needs a model whose pieces hold spaces at their beginning only")
        self.scores = [0.0] * size
        self.parts: list[tuple[int, int] | None] = [None] * size
        self.proper: dict[str, float] = {}
        self.late: dict[str, float] = {}
        for name, score in sorted(scores.items(), key=lambda x: (-x[1], len(x[0]))):
            found, last = merged(list(name), scores)
            if len(found) > 1:
                continue  # never the result of a merge
            if all(len(p) == 1 or self.proper.get(p, score) > score for p in last):
                self.proper[name] = score
                self.scores[self.ids[name]] = score
                self.parts[self.ids[name]] = (self.ids[last[0]], self.ids[last[1]])
            else:
                self.late[name] = score
        limit = max(self.late.values(), default=float("-inf"))
        for name in [n for n, score in self.proper.items() if score <= limit]:
            self.late[name] = self.proper.pop(name)
        self.late_start = commonprefix(list(self.late))  # a text without it holds no late piece


@lru_cache(maxsize=4)
def load(path: str) -> Pieces:
    return Pieces(path)


class Codec:
    """Encodes texts exactly, each distinct word once while it is cached (bounded by characters, long words never).

    The words have two generations: when the new one and the parts hold CACHED_CHARS, it becomes the old one, and what
    is met again moves back.
    """

    def __init__(self, pieces: Pieces) -> None:
        import ahocorasick

        self.pieces = pieces
        self.automaton = ahocorasick.Automaton()
        for name, i in pieces.ids.items():
            if len(name) == 1 or name in pieces.proper:
                self.automaton.add_word(name, (i, len(name)))
        self.automaton.make_automaton()
        self.single = {name: (i,) for name, i in pieces.ids.items() if len(name) == 1 or name in pieces.proper}
        texts = {i: name.replace(MARK, " ").encode() for name, i in pieces.ids.items()}
        texts |= {i: bytes([b]) for b, i in pieces.bytes.items()}
        self.texts = [texts.get(i, b"") for i in range(len(pieces.names))]
        self.texts[pieces.unknown] = " ⁇ ".encode()
        self.decimals = [b"%d " % i for i in range(len(pieces.names))]
        self.fits: dict[int, bool] = {}  # by both ids in one number
        self.segments: dict[str, tuple[bytes, bytes]] = {}
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.odd: dict[str, str] = {}
        self.held = 0

    def compatible(self, a: int, b: int) -> bool:
        """Whether encoding the joint string of two pieces gives these two pieces.

        Time runs backwards: while the younger of the two is taken apart, no merge across the border may come before
        the merge that made it. Of equal scores the left merge comes first.
        """
        names, scores, parts, proper = self.pieces.names, self.pieces.scores, self.pieces.parts, self.pieces.proper
        if names[a][-1] + names[b][0] not in self.pieces.pairs:
            return True
        until, left = float("-inf"), True  # the score of the merge that ends the present state, and its side
        while True:
            across = proper.get(names[a] + names[b])
            if across is not None and (across > until or (across == until and not left)):
                return False
            if parts[a] is None and parts[b] is None:
                return True
            left = parts[b] is None or (parts[a] is not None and scores[a] < scores[b])
            if left:
                until, a = scores[a], parts[a][1]
            else:
                until, b = scores[b], parts[b][0]

    def prefix_table(self, text: str) -> list[tuple[int, int]]:
        """(id, length) of the last piece of every prefix; -1 for a character without a piece.

        Of the pieces that end where the prefix ends, just one fits behind the last piece of what remains.
        """
        last: list[tuple[int, int]] = [(-1, 1)] * (len(text) + 1)
        fits, done, ids = self.fits, 0, len(self.pieces.names)
        for end, (piece, size) in self.automaton.iter(text):  # longest first
            end += 1
            if end == done:
                continue
            before = end - size
            if before and (a := last[before][0]) >= 0:
                pair = a * ids + piece
                good = fits.get(pair)
                if good is None:
                    good = fits[pair] = self.compatible(a, piece)
                if not good:
                    continue
            last[end] = piece, size
            done = end
        return last

    def segment(self, text: str) -> tuple[int, ...]:
        """Ids of a text without a safe cut."""
        if found := self.single.get(text):
            return found
        last, at, ids, sizes = self.prefix_table(text), len(text), [], []
        while at:
            piece, size = last[at]
            ids.append(piece)
            sizes.append(size)
            at -= size
        ids.reverse()
        if self.pieces.late_start not in text and -1 not in ids:
            return tuple(ids)
        names = []
        for size in reversed(sizes):
            names.append(text[at : at + size])
            at += size
        if any(a + b in self.pieces.late for a, b in zip(names, names[1:])):
            names, _ = merged(names, self.pieces.late)
            ids = [self.pieces.ids.get(name, -1) for name in names]
        found: list[int] = []
        for piece, name in zip(ids, names, strict=True):
            found += [piece] if piece >= 0 else [self.pieces.bytes[b] for b in name.encode()]
        return tuple(found)

    def part(self, text: str) -> tuple[bytes, bytes]:
        """Decimal ids of a text without a safe cut, each with a space behind it, and the bytes they decode to."""
        found = self.segments.get(text)
        if found is None:
            ids = self.segment(text)
            found = b"".join(map(self.decimals.__getitem__, ids)), b"".join(map(self.texts.__getitem__, ids))
            if len(text) <= LONGEST_CACHED:
                self.segments[text] = found
                self.held += len(text) + len(found[0])
        return found

    def word(self, text: str) -> tuple[bytes, bytes]:
        """The same of a word with its spaces before it, cut wherever no piece holds the two characters side by side."""
        pairs = self.pieces.pairs
        if pairs.issuperset(map(operator.add, text, text[1:])):
            return self.part(text)
        cuts = [k for k, pair in enumerate(map(operator.add, text, text[1:]), 1) if pair not in pairs]
        found = [self.part(text[start:end]) for start, end in zip([0, *cuts], [*cuts, len(text)], strict=True)]
        return b"".join([ids for ids, _ in found]), b"".join([back for _, back in found])

    def learned(self, word: str) -> bytes:
        ids, back = self.word(MARK + word.replace(" ", MARK))
        if back != b" " + word.encode() and (decoded := back.decode(errors="replace")[1:]) != word:
            self.odd[word] = decoded
        return ids

    def round_trip(self, text: str | None) -> tuple[bytes, str]:
        """Decimal ids, each with a space behind it, without the end id; and the text decoded from them."""
        if not text:
            return b"", ""
        if len(self.fits) > CACHED_PAIRS:
            self.fits = {}
        if self.held > CACHED_CHARS:
            self.segments, self.known, self.old, self.held = {}, {}, self.known, 0
            self.odd = {word: back for word, back in self.odd.items() if word in self.old}
        plain = text.replace(MARK, " ")
        words = plain.split(" ")
        if "" in words:  # spaces side by side or at an end
            words = [c[1:] for c in _RUNS.findall(" " + plain)]
        long: dict[str, bytes] = {}
        for word in set(words).difference(self.known):
            ids = self.old.get(word) or self.learned(word)
            if len(word) > LONGEST_CACHED:
                long[word] = ids
            else:
                self.known[word] = ids
                self.held += len(word) + len(ids)
        if long:
            ids = b"".join([long[w] if w in long else self.known[w] for w in words])
        else:
            ids = b"".join(map(self.known.__getitem__, words))
        if not self.odd:
            return ids, plain
        words = [self.odd.get(w, w) for w in words]
        for word in long:
            self.odd.pop(word, None)
        return ids, " ".join(words)

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids; control ids give nothing. Bytes that are no UTF-8 become U+FFFD."""
        found = b"".join([self.texts[i] for i in ids]).decode(errors="replace")
        return found[1:] if found.startswith(" ") else found


_CODECS: dict[str, Codec] = {}


def codec(pieces: Pieces) -> Codec:
    """The codec of this Python worker, kept between tasks."""
    if pieces.key not in _CODECS:
        _CODECS.clear()
        _CODECS[pieces.key] = Codec(pieces)
    return _CODECS[pieces.key]


def sentence_piece_round_trip(docs: DataFrame, model: str, keep_ids: bool = False) -> DataFrame:
    """Encode every whole text as the library does with a BPE model file and an end id, and decode the ids.

    Columns: ``doc_id``, ``n_tokens`` (the end id included), ``ids_sha256`` (of the decimal ids joined by one space),
    ``decoded_sha256``, and with ``keep_ids`` also ``ids`` and ``decoded``. One row per input row, repeated rows
    included. A NULL text counts as empty: the end id alone, decoded as nothing. The strings of control pieces within a
    text are ordinary text; characters without a piece become bytes. An empty table gives no rows. Only id and text are
    read. A model of another kind (unused pieces, a normaliser that changes texts, no byte pieces) is a ValueError.
    """
    pieces = load(model)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        own, end = codec(pieces), str(pieces.end).encode()
        for batch in byte_slices(batches, column=1):
            counts, ids, decoded, kept, texts = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                found, back = own.round_trip(text)
                found += end
                counts.append(found.count(b" ") + 1)
                ids.append(hashlib.sha256(found).hexdigest())
                decoded.append(hashlib.sha256(back.encode()).hexdigest())
                if keep_ids:
                    kept.append(list(map(int, found.split())))
                    texts.append(back)
            columns = {
                "doc_id": batch.column(0),
                "n_tokens": pa.array(counts, pa.int64()),
                "ids_sha256": pa.array(ids, pa.string()),
                "decoded_sha256": pa.array(decoded, pa.string()),
            }
            if keep_ids:
                columns |= {"ids": pa.array(kept, pa.list_(pa.int64())), "decoded": pa.array(texts, pa.string())}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    schema = f"doc_id {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(run, schema + ", ids array<bigint>, decoded string" * keep_ids)
