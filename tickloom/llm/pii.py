"""PII: fixed patterns, and a semi-Markov conditional random field over whole candidate spans."""

from __future__ import annotations

import bisect
import hashlib
import math
import random
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import byte_slices, written

KINDS = ("email", "ip", "card", "phone")
TRAIN_WINDOWS = 600
MAX_TOKENS = 5
MAX_CHARS = 80
CONTEXT = 2
EPOCHS = 6
CONFIDENCE = 0.9

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def octets(text: str) -> bool:
    """Whether no dotted part exceeds 255, for parts of any length."""
    return all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in text.split(".")))


def emails(text: str) -> Iterator[Span]:
    """Anchored at each ``@``: the local part is the run of its characters before it, back to the last match."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield "email", start, found.end()
            done = found.end()
        else:
            done = at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[Span]:
    """The pattern spans by kind as listed, then by start; leftmost and non-overlapping within a kind."""
    found = list(emails(text)) if "@" in text else []
    if _DIGIT.search(text):
        found += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if octets(m[0])]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16 and 16 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
                found.append(("card", m.start(), m.end()))
        if "+" in text:
            found += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(digits_of(m[0])) <= 15]
    return found


# Words that introduce an entity, by kind.
CUES = {
    "email": {"email", "e-mail", "mail", "write", "contact", "mailto"},
    "ip": {"ip", "host", "address", "server", "from", "addr"},
    "card": {"card", "visa", "credit", "mastercard", "amex", "cc"},
    "phone": {"phone", "tel", "call", "mobile", "fax", "telephone", "ring"},
}
_TRIM_LEFT, _TRIM_RIGHT = " \"'<[{|*$%&#!?,;:.=", " \"'>]}|*$%&#!?,;:.=)"
_MAIL_WORD = re.compile(r"[\[({]?(at|dot)[\])}]?$", re.I)
_MAIL_WORDS = re.compile(
    r"[A-Za-z0-9._%+-]+ ?(?:[\[({] ?at ?[\])}]|@) ?[A-Za-z0-9-]+(?: ?(?:[\[({] ?dot ?[\])}]|\.) ?[A-Za-z0-9-]+)+$", re.I
)
# A spelled-out address: the local part with its "at", the labels; a domain name has at most 127 of them.
_MAIL_AT = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:[\[({] ?at ?[\])}]|@) ?[A-Za-z0-9-]++", re.I)
_MAIL_DOT = re.compile(r"(?: ?[\[({] ?dot ?[\])}] ?|\.)[A-Za-z0-9-]++", re.I)
MAX_LABELS = 127
MAX_DIGITS = 19
_PHONE_FORM = re.compile(r"(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-][0-9]{2,4}){1,4}$")
_NUMBERS = re.compile(r"[0-9]+")
_SEED = 7


@dataclass(frozen=True)
class Window:
    """Neighbouring tokens of a text, as (start, end) code points; spans that start from ``since`` on and before ``until``
    are its own, the others those of the windows it overlaps."""

    text: str
    tokens: tuple[tuple[int, int], ...]
    since: int = 0
    until: int = 1 << 62


def tokens_around(text: str, hint: tuple[int, int]) -> tuple[int, int]:
    """The whitespace-delimited token around a match, cut at MAX_CHARS on either side."""
    low, high = hint
    stop = max(0, low - MAX_CHARS)
    while low > stop and not text[low - 1].isspace():
        low -= 1
    stop = min(len(text), high + MAX_CHARS)
    while high < stop and not text[high].isspace():
        high += 1
    return low, high


_HINT = re.compile(r"[0-9@][^\s]{0,79}|[\[({]\s?(?:at|dot)\s?[\])}]", re.I)
_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|[^\x00-\x7F\s]+|[^\sA-Za-z0-9]")
_WORD = re.compile(r"\S+")
_CUE = re.compile(r"[^\s\"'<>{}\[\]|:=,;()]+")
OVERLAP = 4 * MAX_CHARS


def windows(text: str) -> Iterator[Window]:
    """Groups of nearby tokens that hold a digit, an ``@`` or a spelled-out one, with a little context.

    A long group is cut into windows that overlap by more than the longest segment of numbers.
    """
    near = MAX_CHARS
    hints = [tokens_around(text, m.span()) for m in _HINT.finditer(text)]
    hints += [(m.start(), _labels(text, m.end())[-1]) for m in _MAIL_AT.finditer(text)]
    groups: list[list[int]] = []
    for low, high in sorted(hints):
        if groups and low <= groups[-1][1] + near:
            groups[-1][1] = max(high, groups[-1][1])
        else:
            groups.append([low, high])
    previous = 0
    for low, high in groups:
        left, right = max(previous, low - near), min(len(text), high + near)
        since = left
        while True:
            end = right if right - left <= 2000 + OVERLAP else left + 2000
            until = right if end == right else end - OVERLAP // 2
            if found := tuple(m.span() for m in _TOKEN.finditer(text, left, end)):
                yield Window(text, found, since, until)
            if end == right:
                break
            left, since = end - OVERLAP, until
        previous = high


def _labels(text: str, at: int) -> list[int]:
    """The end of an address's first label, and of each label after it."""
    ends = [at]
    while len(ends) < MAX_LABELS and (m := _MAIL_DOT.match(text, ends[-1])):
        ends.append(m.end())
    return ends


def _edges(text: str, low: int, high: int) -> bool:
    """Whether a run of numbers stands by itself: between spaces, or punctuation that does not go on with digits."""
    left, right = text[max(0, low - 2) : low], text[high : high + 2]
    free = not left or left[-1].isspace() or left[-1] in _TRIM_LEFT + "(>" and not left[0].isdigit()
    return free and (not right or right[0].isspace() or right[0] in _TRIM_RIGHT + "<" and not right[-1].isdigit())


def candidates(window: Window) -> list[list[tuple[int, int, int]]]:
    """By first token: (last token + 1, start, end) of segments that could be an entity.

    These are neighbouring words, numbers with what stands between their digits, and spelled-out addresses, the last two
    also inside of words.
    """
    text, tokens = window.text, window.tokens
    first = {a: i for i, (a, _) in enumerate(tokens)}
    after = {b: i + 1 for i, (_, b) in enumerate(tokens)}
    start, end = tokens[0][0], tokens[-1][1]
    spans: set[tuple[int, int]] = set()
    words = [m.span() for m in _WORD.finditer(text, start, end)]
    plain = [not _DIGIT.search(text, *t) and text.find("@", *t) < 0 for t in words]
    for i, (low, _) in enumerate(words):
        spelled = False
        for j in range(i, min(i + MAX_TOKENS, len(words))):
            if words[j][1] - low > MAX_CHARS:
                break
            spelled = spelled or bool(_MAIL_WORD.match(text[words[j][0] : words[j][1]]))
            if spelled or not (plain[i] or plain[j]):
                whole = text[low : words[j][1]]
                spans.add((
                    low + len(whole) - len(whole.lstrip(_TRIM_LEFT)),
                    words[j][1] - (len(whole) - len(whole.rstrip(_TRIM_RIGHT))),
                ))
    for i, (low, high) in enumerate(tokens):
        if not (text[low] in "+(" or text[low].isdigit() and text[low].isascii()):
            continue
        digits = 0
        for a, b in tokens[i:]:
            gap = text[a - 1] if a > low else ""
            if b - low > MAX_CHARS or not (text[a] in "+().-" or "0" <= text[a] <= "9") or gap.isspace() and gap != " ":
                break
            if "0" <= text[a] <= "9":
                digits += b - a
                if digits > MAX_DIGITS:
                    break
                if digits >= 7 and _edges(text, low, b):
                    spans.add((low, b))
    for m in _MAIL_AT.finditer(text, start, end):
        if len(ends := _labels(text, m.end())) > 1:
            whole = (m.start(), ends[-1])  # an address is no address of its parts
            spans = {x for x in spans if x[0] < whole[0] or x[1] > whole[1]} | {whole}
    found: list[list[tuple[int, int, int]]] = [[] for _ in tokens]
    for low, high in sorted(spans):
        if high > low and low in first and high in after:
            found[first[low]].append((after[high], low, high))
    return found


def cues(window: Window, low: int) -> tuple[str, ...]:
    """Features of the words before a place."""
    near = _CUE.findall(window.text, max(window.tokens[0][0], low - MAX_CHARS), low)
    before = {w.strip(_TRIM_LEFT + _TRIM_RIGHT).lower() for w in near[-CONTEXT:]}
    return tuple(f"cue={kind}" for kind in KINDS if before & CUES[kind])


def features(window: Window, low: int, high: int) -> tuple[str, ...]:
    """Features of a whole span; the field crosses each with the kind."""
    span = window.text[low:high]
    numbers = [len(x) for x in _NUMBERS.findall(span)]
    n = sum(numbers)
    other = re.sub(r"[0-9 ().+-]", "", span)
    out = [
        f"digits={min(n, 20)}",
        f"groups={min(len(numbers), 6)}",
        f"tokens={min(len(span.split()), MAX_TOKENS)}",
        f"form={'mail' if _MAIL_WORDS.match(span) else 'phone' if _PHONE_FORM.match(span) and 7 <= n <= 15 else '-'}",
        f"other={bool(other)}",
    ]
    if not other and 16 <= n <= 19:
        out.append(f"luhn={luhn(digits_of(span))}")
    if re.fullmatch(r"[0-9]+(\.[0-9]+){3}", span):
        out.append(f"octets={octets(span)}")
    if out[3] == "form=mail":
        out.append(f"open={bool(_MAIL_DOT.match(window.text, high))}")
    if span.startswith("+"):
        out.append("plus")
    if "(" in span and ")" in span:
        out.append("brackets")
    return tuple(out)


@dataclass(frozen=True)
class Field:
    """Weights of (kind, feature); tokens outside of spans score 0."""

    weights: dict[tuple[str, str], float]

    def scored(self, window: Window) -> list[list[tuple[int, str, float, tuple[str, ...], int, int]]]:
        rows = []
        for i, options in enumerate(candidates(window)):
            row = []
            before: dict[int, tuple[str, ...]] = {}
            for j, low, high in options:
                if low not in before:
                    before[low] = cues(window, low)
                own = features(window, low, high) + before[low]
                for kind in KINDS:
                    row.append((j, kind, sum(self.weights.get((kind, f), 0.0) for f in own), own, low, high))
            rows.append(row)
        return rows

    @staticmethod
    def sums(rows) -> tuple[list[float], list[float]]:
        """Log sums over all segmentations before and after each token boundary."""
        n = len(rows)
        terms = [[] for _ in range(n + 1)]
        before = [0.0] * (n + 1)
        for i in range(n + 1):
            if i:
                before[i] = logsum(terms[i])
            if i < n:
                terms[i + 1].append(before[i])
                for j, _, score, *_ in rows[i]:
                    terms[j].append(before[i] + score)
        after = [0.0] * (n + 1)
        for i in range(n - 1, -1, -1):
            after[i] = logsum([after[i + 1], *(score + after[j] for j, _, score, *_ in rows[i])])
        return before, after

    def decode(self, window: Window) -> list[tuple[Span, float]]:
        """Best segmentation: spans with their posterior probabilities."""
        rows = self.scored(window)
        n = len(rows)
        best, choice = [0.0] * (n + 1), [None] * n
        for i in range(n - 1, -1, -1):
            best[i] = best[i + 1]
            for option in rows[i]:
                if (value := option[2] + best[option[0]]) > best[i]:
                    best[i], choice[i] = value, option
        if not any(choice):
            return []
        before, after = self.sums(rows)
        found, i = [], 0
        while i < n:
            if choice[i] is None:
                i += 1
                continue
            j, kind, score, _, low, high = choice[i]
            found.append(((kind, low, high), math.exp(min(0.0, before[i] + score + after[j] - after[0]))))
            i = j
        return found


def logsum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def fit(examples: list[tuple[Window, list[Span]]], epochs: int = EPOCHS, rate: float = 0.3, l2: float = 1e-3) -> Field:
    """Gradient steps on the log-likelihood of the given spans, one window at a time."""
    field = Field(defaultdict(float))
    weights = field.weights
    rng = random.Random(_SEED)
    for epoch in range(epochs):
        rng.shuffle(examples)
        step = rate / (1 + epoch)
        for window, gold in examples:
            rows = field.scored(window)
            wanted = set(gold)
            before, after = field.sums(rows)
            change: dict[tuple[str, str], float] = defaultdict(float)
            for i, row in enumerate(rows):
                for j, kind, score, own, low, high in row:
                    p = math.exp(min(0.0, before[i] + score + after[j] - after[0]))
                    g = ((kind, low, high) in wanted) - p
                    if abs(g) > 1e-4:
                        for f in own:
                            change[kind, f] += g
            for key, g in change.items():
                weights[key] += step * (g - l2 * weights[key])
    return Field(dict(weights))


def reachable(window: Window, spans: list[Span]) -> list[Span] | None:
    """Those of the spans that lie in the window; None if one of them is no candidate segment."""
    low, high = window.tokens[0][0], window.tokens[-1][1]
    own = [s for s in spans if s[1] < high and s[2] > low]
    options = {(a, b) for row in candidates(window) for _, a, b in row}
    return own if all((a, b) in options for _, a, b in own) else None


def respelled(kind: str, span: str, rng: random.Random) -> str | None:
    """The same datum in a spelling that the patterns do not know."""
    if kind == "email":
        left, right = rng.choice((("[", "]"), ("(", ")")))
        local, domain = span.split("@")
        pad = rng.choice(("", "", " "))
        at, dot = (f" {left}{pad}{x}{pad}{right} " for x in ("at", "dot"))
        return local + at + (domain.replace(".", dot) if rng.random() < 0.7 else domain)
    if kind == "phone":
        own = re.sub(r"^\+[0-9]{1,3} ?", "", span)
        return own if rng.random() < 0.6 else re.sub(r"[ ().-]+", rng.choice("-."), own).strip("-.")
    return None


def harmless(rng: random.Random) -> str:
    """A number that is no personal datum."""
    n = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    return rng.choice(
        (
            lambda: f"{rng.randint(1900, 2100)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}",
            lambda: f"{rng.randint(10, 23)}:{rng.randint(10, 59)}:{rng.randint(10, 59)}",
            lambda: f"{n(1)}.{n(1)}.{n(2)}",
            lambda: f"{rng.randint(300, 999)}.{n(3)}.{n(3)}.{n(3)}",
            lambda: f"{rng.randint(1, 999)},{n(3)}",
            lambda: f"{n(3)} {n(2)} {n(4)}",
            lambda: f"{n(4)} {n(4)}",
            lambda: f"{n(2)}/{n(2)}/{n(4)}",
            lambda: f"{n(rng.randint(1, 15))}",
            lambda: f"{n(5)}-{n(5)}-{n(1)}",
            lambda: f"${n(3)}.{n(2)}",
            lambda: f"{n(3)}.{n(1)}%",
            lambda: f"v{n(1)}.{n(2)}@{n(3)}",
        )
    )()


def training_windows(texts: list[str], limit: int) -> list[tuple[Window, list[Span]]]:
    """Windows labelled by the patterns, and each again with the datum respelled or a harmless number in its place."""
    rng = random.Random(_SEED)
    found = []
    for text in texts:
        spans = base_spans(text)
        for window in windows(text):
            if len(found) >= limit:
                return found
            gold = reachable(window, spans)
            if gold is None or len(window.tokens) > 240:
                continue
            found.append((window, gold))
            edges = [window.tokens[0][0], *(x for _, low, high in sorted(gold, key=lambda g: g[1]) for x in (low, high))]
            edges.append(window.tokens[-1][1])
            for kind, low, high in gold:
                before = max([e for e in edges if e <= low and e != low] + [low - 24, 0])
                after = min([e for e in edges if e >= high and e != high] + [high + 24, len(text)])
                left, right = text[before:low], text[high:after]
                cue = rng.choice(sorted(CUES[kind]) + [""] * 6)
                left += cue + rng.choice((" ", " ", ":", '":"')) if cue else ""
                other = respelled(kind, text[low:high], rng)
                for middle, label in ((other, True), (harmless(rng), False)):
                    if middle:
                        whole = left + middle + right
                        made = Window(whole, tuple(m.span() for m in _TOKEN.finditer(whole)))
                        gold_here = [(kind, len(left), len(left) + len(middle))] if label else []
                        if made.tokens and reachable(made, gold_here) is not None:
                            found.append((made, gold_here))
    return found


def chosen(parts: set[str], limit: int) -> list[str]:
    """The ``limit`` of them whose digests are lowest, by digest."""
    return sorted(parts, key=lambda p: (hashlib.blake2b(p.encode("utf-8", "surrogatepass"), digest_size=8).digest(), p))[:limit]


def train_pii(docs: DataFrame, limit: int = TRAIN_WINDOWS) -> Field:
    """Fit the field on windows around pattern spans, looked for in all documents.

    Of each kind the windows whose digests are lowest are taken in turn, ``limit`` in all: a rare kind gives all it has.
    A task passes on at most ``limit`` of each kind, and so many reach the driver, all of bounded length. Without a
    pattern span in any document the field is empty and adds nothing.
    """

    def around(batches):
        found: dict[str, set[str]] = {k: set() for k in KINDS}
        for batch in byte_slices(batches):
            for text in batch.column(0).to_pylist():
                spans = base_spans(text)
                for w in windows(text) if spans else ():
                    low, high = w.tokens[0][0], w.tokens[-1][1]
                    if high - low <= 400:
                        for kind in {k for k, a, b in spans if a >= low and b <= high}:
                            found[kind].add(text[low:high])
                            if len(found[kind]) > 2 * limit:
                                found[kind] = set(chosen(found[kind], limit))
        rows = [(kind, part) for kind, parts in found.items() for part in chosen(parts, limit)]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], ["kind", "part"])

    labelled = docs.select("text").where(F.col("text").isNotNull()).mapInArrow(around, "kind string, part string")
    labelled = written(labelled, "windows")
    ranked: dict[tuple[int, str], str] = {}
    for kind in KINDS:
        mine = labelled.where(F.col("kind") == kind).select("part").distinct().orderBy(F.xxhash64("part"), "part").limit(limit)
        ranked |= {(i, kind): r.part for i, r in enumerate(mine.collect())}
    parts = list(dict.fromkeys(ranked[k] for k in sorted(ranked)))[:limit]
    return fit(training_windows(parts, 3 * limit))


def all_spans(text: str, field: Field, confidence: float = CONFIDENCE) -> tuple[list[Span], list[Span]]:
    """Pattern spans, and with them those of the field that it is sure of and that overlap no pattern span."""
    base = base_spans(text)
    if not field.weights:
        return base, base
    taken = sorted((a, b) for _, a, b in base)
    reach = 0
    highest = [reach := max(reach, b) for _, b in taken]
    added = []
    for window in windows(text):
        for (kind, low, high), sure in field.decode(window):
            before = bisect.bisect_left(taken, (high,))
            if sure >= confidence and window.since <= low < window.until and not (before and highest[before - 1] > low):
                added.append((kind, low, high))
    order = {k: i for i, k in enumerate(KINDS)}
    return base, sorted({*base, *added}, key=lambda s: (order[s[0]], s[1], s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in angle brackets; overlapping spans become one mark."""
    out, at = [], 0
    for kind, low, high in sorted(spans, key=lambda s: (s[1], -s[2])):
        if low >= at:
            out += [text[at:low], f"<{kind}>"]
        at = max(at, high)
    return "".join([*out, text[at:]])


def pii_spans(docs: DataFrame, field: Field, confidence: float = CONFIDENCE) -> DataFrame:
    """Personal data in every whole text.

    Columns: ``doc_id``, ``n_email``, ``n_ip``, ``n_card``, ``n_phone`` (pattern spans), ``base_sha256`` (of them),
    ``spans`` (all, as kind:start:end in code points, end exclusive, by kind, then start), ``redacted`` (the text with
    all spans replaced). One row per input row. A NULL text has no spans and stays NULL. Only id and text are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)  # a few hundred weights
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def scan(batches):
        field = shared.value
        for batch in byte_slices(batches, column=1):
            counts, digests, spans, texts = [], [], [], []
            for text in batch.column(1).to_pylist():
                base, every = all_spans(text or "", field, confidence)
                kinds = [k for k, _, _ in base]
                counts.append([kinds.count(k) for k in KINDS])
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined(every))
                texts.append(redacted(text, every) if every else text)
            columns = {"doc_id": batch.column(0)}
            for i, kind in enumerate(KINDS):
                columns[f"n_{kind}"] = pa.array([c[i] for c in counts], pa.int64())
            columns |= {
                "base_sha256": pa.array(digests, pa.string()),
                "spans": pa.array(spans, pa.string()),
                "redacted": pa.array(texts, pa.string()),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return docs.select("doc_id", "text").mapInArrow(
        scan, f"doc_id {id_type}, {counts}, base_sha256 string, spans string, redacted string"
    )


def redacted_documents(docs: DataFrame, field: Field, confidence: float = CONFIDENCE) -> DataFrame:
    """The documents with all spans replaced by their kinds; ``n_chars``, where there is one, follows the new text.

    A NULL text stays NULL. All columns and rows stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def redact(arrays):
        for array in arrays:
            found: list[str | None] = []
            for batch in byte_slices([pa.RecordBatch.from_arrays([array], ["text"])]):
                for text in batch.column(0).to_pylist():
                    spans = all_spans(text, shared.value, confidence)[1] if text else []
                    found.append(redacted(text, spans) if spans else text)
            yield pa.array(found, pa.string())

    redact.__annotations__ = {"arrays": Iterator[pa.Array], "return": Iterator[pa.Array]}
    done = docs.withColumn("text", F.arrow_udf(redact, "string")(F.col("text")))
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return done
