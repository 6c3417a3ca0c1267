"""Benchmark decontamination by template canonicalisation.

Each text is matched in two forms.  In the plain form, which finds verbatim
copies in any case and layout, it is its lower-cased words.  In the other it
becomes a sequence of template words: numbers (and number words), names
(capitalised words anywhere that are not ``COMMON``, neighbours together, over
a title's or initial's full stop too, unless an empty line is between them) and
units (after a number, currency signs before it included) turn into the typed
placeholders ``0``, ``1`` and ``2``; all other words are lower-cased.  No other
template word consists of ASCII digits, so a placeholder cannot be mistaken.
Windows of ``WINDOW`` words, of template words at least ``LITERALS`` literal,
are hash-joined between documents and benchmark items.

Matches with equal distance of places in document and item are a piece.  An
occurrence is a chain of pieces in the same order in both, none further from
the last than the item is long; inserted or missing words lie between its
pieces.  Over the whole chain each slot value of the item stands for one value
of the document.  A document holds an item if one chain covers ``COVERAGE`` of
the item's windows in one form: reparameterised if the best template chain has
other slot values, else verbatim.

An item of fewer than ``WINDOW`` words is one window, matched whole and verbatim;
one of fewer than ``LITERALS`` only where it stands by itself, between breaks.

Scale.  A text is cut into words once; a task keeps the hash and kind of every
word it has met and works on arrays of a whole slice of texts.  Windows of
documents never travel unless they may match: tasks test their hashes against
a bitmap of the benchmark's window hashes, whose size is fixed (2 MB) whatever
the benchmark's, and only what passes is joined by hash, with an exact
comparison of the window.  A larger benchmark lets more windows through, never
fewer.  Both join sides are plain exchanges, so a window that stands in a third
of all documents can be split.  What is gathered per document and item is
bounded by their own lengths, and only pairs whose windows reach ``COVERAGE`` at
all are chained.

Edge cases.  Null and empty texts hold nothing, items without words are never
reported.  An item without slots has the plain form only.  Rows with equal id
and text count once; null ids are kept apart by their text.  Items with equal
text are each reported.  Empty tables give an empty result.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import saved, text_bytes

WINDOW = 5
LITERALS = 3
COVERAGE = 0.8
#: log2 of the bitmap's bits.
BITMAP = 24
#: Words a task remembers, and bytes of texts worked on at once.
WORDS = 500_000
SLICE_BYTES = 1 << 20

# Units after a number and number words.
UNITS = ("kg", "g", "mg", "lb", "lbs", "oz", "km", "m", "cm", "mm", "mi", "ft", "in", "miles", "meters",
         "metres", "feet", "inches", "l", "ml", "liters", "litres", "gallons", "s", "ms", "min", "h",
         "hours", "hour", "minutes", "minute", "seconds", "second", "days", "day", "weeks", "week",
         "months", "month", "years", "year", "mph", "kmh", "usd", "eur", "gbp", "dollars", "dollar",
         "euros", "euro", "cents", "percent", "degrees", "kb", "mb", "gb", "tb", "hz", "khz", "mhz",
         "ghz", "w", "kw", "v", "a")
NUMBER_WORDS = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten",
                "eleven", "twelve", "twenty", "thirty", "forty", "fifty", "hundred", "thousand", "million")

#: Words that are no names when capitalised, in whatever place.
COMMON = NUMBER_WORDS + tuple(
    "a about above according add after again all also although always among an and another answer any approximately "
    "are as assume at because before below between both but by calculate can choose compare complete compute consider "
    "convert count could days decide define describe despite determine did divide do does draw during each either "
    "estimate evaluate even every everyone explain express few finally find first five for from get give "
    "given had half has have he hence her here his how however i if imagine in instead into is it its just last later "
    "let list look make many more most multiply my name neither next no nobody none not note nothing now of often on "
    "once only or other our over pay people perhaps please prove put question round same second select she should "
    "show similarly simplify since so solve some someone sometimes soon state still subtract such suppose take than "
    "that the their them then there therefore these they third this those though through thus to today together "
    "tomorrow translate two under unless until up upon use using was we were what when whenever where whether which "
    "while who whom whose why will with within without would write yes yesterday you your".split())


# Titles whose full stop belongs to the name after them.
TITLES = frozenset(("mr", "mrs", "ms", "dr", "prof", "st", "sr", "jr", "mx"))

#: Signs of the word sequence that are no words: a text's end, a break between
#: clauses, an end of line, a currency sign and the percent sign.
END, BREAK, LINE, MONEY, PERCENT = b"\x04", b"\x03", b"\x06", b"$", b"%"
SIGNS = (END, BREAK, LINE, MONEY, PERCENT)
#: Stand for the point and the comma inside a number.
POINT, COMMA = b"\x01", b"\x02"
#: Letters, digits and non-ASCII bytes are kept; blanks, apostrophe and hyphen
#: separate words; all other signs are a break too.
_TABLE = bytes(c if 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c > 127 or c in (1, 2, 4, 36, 37)
               else 6 if c == 10 else 32 if c in (9, 11, 12, 13, 32, 39, 45) else 3 for c in range(256))
_POINT = re.compile(rb"\.(?=[0-9])(?<=[0-9].)")
_COMMA = re.compile(rb",(?=[0-9])(?<=[0-9].)")
_EMPTY_LINE = re.compile(rb"\n[ \t\r\x0b\x0c]*\n")
_CONTROL = bytes(range(9)) + bytes(range(14, 32))
_NUMBER = re.compile("([0-9]+(?:[\x01\x02][0-9]+)*)")
_SIGN = re.compile("^[€£¥]+$")
_SIGNED = re.compile("^([€£¥])([0-9].*)$")

# Kinds of pieces of words.
LITERAL, NAME, INITIAL, TITLE, NUMBER, UNIT, SLOT_UNIT, CURRENCY = range(8)
#: Odd multipliers of a window's words.
_MULT = np.array([0x9E3779B97F4A7C15 * (2 * i + 1) % 2**64 for i in range(WINDOW)], dtype=np.uint64)
#: Tells hashes of plain windows (of each length) from those of template windows.
_PLAIN = [np.uint64(0xD1B54A32D192ED03 * (2 * i + 1) % 2**64) for i in range(WINDOW + 1)]
_PLACES = (b"0", b"1", b"2")
_PLACE = np.array([zlib.crc32(x) for x in _PLACES], dtype=np.uint64)
_COMMON = frozenset(COMMON)
_UNITS = frozenset(UNITS)
_NUMBERS = frozenset(NUMBER_WORDS)
#: The same as bytes: kinds in whatever case, and words that are no names.
_SMALL = {w.encode(): UNIT for w in UNITS} | {w.encode(): NUMBER for w in NUMBER_WORDS}
_COMMON_BYTES = frozenset(w.encode() for w in COMMON)
_TITLE_BYTES = frozenset(w.encode() for w in TITLES)


def cut(text: bytes) -> list[bytes]:
    """Words as written and signs, in order."""
    text = text.translate(None, _CONTROL) if any(c in text for c in (POINT, COMMA, BREAK, END, LINE)) else text
    if _POINT.search(text) or _COMMA.search(text):
        text = _COMMA.sub(COMMA, _POINT.sub(POINT, text))
    if b"\n" in text:
        text = _EMPTY_LINE.sub(b"\n;\n", text)
    text = text.translate(_TABLE)
    for sign in (BREAK, LINE, MONEY, PERCENT):
        if sign in text:
            text = text.replace(sign, b" " + sign + b" ")
    return text.split()


def pieces_of(word: str) -> list[tuple[int, str]]:
    """(kind, lower-case text) of a word's pieces: one, but for words that
    hold digits, whose numbers and letters are apart."""
    low = word.lower()
    if not any("0" <= c <= "9" for c in word):
        if low in _NUMBERS:
            return [(NUMBER, low)]
        if _SIGN.match(word):
            return [(CURRENCY, low)]
        if low in _UNITS:
            return [(UNIT, low)]
        if word[0].isupper() and low not in _COMMON:
            if low in TITLES:
                return [(TITLE, low)]
            if len(word) == 1:
                return [(INITIAL, low)]
            if word[1].islower():
                return [(NAME, low)]
        return [(LITERAL, low)]
    signed = _SIGNED.match(word)
    out = [(SLOT_UNIT, signed[1])] if signed else []
    parts = [p for p in _NUMBER.split(signed[2] if signed else word) if p]
    for i, p in enumerate(parts):
        if "0" <= p[0] <= "9":
            out.append((NUMBER, p.replace("\x01", ".").replace("\x02", ",")))
        else:
            unit = i and i == len(parts) - 1 and p.lower() in _UNITS
            out.append((SLOT_UNIT if unit else LITERAL, p.lower()))
    return out


class Words(dict):
    """Numbers words as they come; keeps the hash of each (lower-cased) and
    the kinds, hashes and texts of its pieces."""

    def __init__(self):
        super().__init__()
        self.low: list[bytes] = []
        self.piece_text: list[str] = []
        self._hash, self._first, self._count, self._kind, self._piece = [], [], [], [], []
        self._arrays = [np.zeros(0, t) for t in (np.uint64, np.int64, np.int64, np.int64, np.uint64)]
        for sign in SIGNS:
            self[sign]

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        self._first.append(len(self.piece_text))
        if n < len(SIGNS) or word.isalpha():  # ASCII letters: one piece, by the rules of pieces_of
            low = word.lower()
            kind = _SMALL.get(low)
            if kind is None:
                kind = LITERAL
                if n >= len(SIGNS) and word[0] <= 90 and low not in _COMMON_BYTES:
                    kind = (TITLE if low in _TITLE_BYTES else INITIAL if len(word) == 1
                            else NAME if word[1] > 90 else LITERAL)
            h = zlib.crc32(low)
            self._kind.append(kind)
            self._piece.append(h)
            self.piece_text.append(low.decode())
            self._count.append(1)
        else:
            text = word.decode("utf-8", "replace")
            low, pieces = text.lower().encode(), pieces_of(text)
            h = zlib.crc32(low)
            self._count.append(len(pieces))
            for kind, t in pieces:
                self._kind.append(kind)
                self._piece.append(zlib.crc32(t.encode()))
                self.piece_text.append(t)
        self.low.append(low)
        self._hash.append(h)
        return n

    def arrays(self) -> list[np.ndarray]:
        """hash, first piece and number of pieces by word; kind and hash by piece."""
        new = (self._hash, self._first, self._count, self._kind, self._piece)
        self._arrays = [np.concatenate([a, np.array(x, dtype=a.dtype)]) for a, x in
                        zip(self._arrays, new, strict=True)]
        self._hash, self._first, self._count, self._kind, self._piece = [], [], [], [], []
        return self._arrays


class Forms:
    """Both forms of a slice of texts, as arrays over all their words."""

    def __init__(self, texts: list[bytes], words: Words):
        tokens: list[bytes] = []
        for t in texts:
            tokens += cut(t)
            tokens.append(END)
        ids = np.fromiter(map(words.__getitem__, tokens), dtype=np.int64, count=len(tokens))
        self.words = words
        self.hash_of, first, count, self.kind_of, self.piece_of = words.arrays()
        text_of = np.cumsum(ids == 0) - (ids == 0)
        real = ids >= len(SIGNS)
        # Whether a word stands first, or last, between breaks.
        stop = (ids == 0) | (ids == 1) | (ids == 2)
        edge = np.ones(len(ids) + 2, dtype=bool)
        edge[1:-1] = stop
        self.plain, self.plain_text = ids[real], text_of[real]
        self.opens, self.closes = edge[:-2][real], edge[2:][real]
        # Pieces in order, ends of lines left out.
        keep = ids != 2
        ids, text_of = ids[keep], text_of[keep]
        n = count[ids]
        at = np.repeat(first[ids] - np.cumsum(n) + n, n) + np.arange(n.sum())
        self._templates(np.repeat(ids, n), np.repeat(text_of, n), at)

    def _templates(self, ids: np.ndarray, text_of: np.ndarray, piece: np.ndarray) -> None:
        kind = np.where(ids < len(SIGNS), np.choose(np.minimum(ids, 4), [-1, -1, -1, CURRENCY, UNIT]),
                        self.kind_of[piece])
        nameable = (kind == NAME) | (kind == INITIAL) | (kind == TITLE)
        # A break between a title or an initial and a name is part of the name.
        joint = np.zeros(len(kind), dtype=bool)
        if len(kind) > 2:
            joint[1:-1] = (ids[1:-1] == 1) & ((kind[:-2] == TITLE) | (kind[:-2] == INITIAL)) & nameable[2:]
        ids, text_of, piece, kind, nameable = (x[~joint] for x in (ids, text_of, piece, kind, nameable))
        before = np.r_[False, nameable[:-1]]
        start = nameable & ~before
        run = np.cumsum(start) - 1
        if start.any():
            full = np.zeros(int(start.sum()), dtype=bool)
            np.logical_or.at(full, run[nameable], (kind != INITIAL)[nameable])
            name = nameable & full[np.maximum(run, 0)]
        else:
            name = nameable
        number = kind == NUMBER
        digits = number & (ids >= len(SIGNS))
        # Units stand after a number in digits, currency signs before one.
        shown = np.zeros(len(kind), dtype=bool)
        shown[digits] = np.fromiter((self.words.piece_text[p][0].isdigit() for p in piece[digits].tolist()),
                                    dtype=bool, count=int(digits.sum()))
        unit = ((kind == UNIT) & np.r_[False, shown[:-1]]) | (kind == SLOT_UNIT) | (
            (kind == CURRENCY) & np.r_[shown[1:], False])
        place = np.where(number, 0, np.where(name, 1, np.where(unit, 2, -1)))
        keep = (place >= 0) | (ids >= len(SIGNS))
        keep &= ~(name & ~start)
        # The end of each name, for its value.
        last = np.flatnonzero(nameable & ~np.r_[nameable[1:], False])
        self._name_end = np.zeros(len(kind), dtype=np.int64)
        self._name_end[np.flatnonzero(start)] = last
        self._ids, self._piece = ids, piece
        self.source = np.flatnonzero(keep)
        self.place, self.text = place[keep], text_of[keep]
        self.hash = np.where(self.place >= 0, _PLACE[np.maximum(self.place, 0)], self.piece_of[piece[keep]])

    def word(self, i: int) -> bytes:
        """Template word i."""
        p = int(self.place[i])
        return _PLACES[p] if p >= 0 else self.words.piece_text[int(self._piece[self.source[i]])].encode()

    def value(self, i: int) -> str | None:
        """The slot value of template word i (None for a literal)."""
        p, at = int(self.place[i]), int(self.source[i])
        if p < 0:
            return None
        if p == 1:
            return " ".join(self.words.piece_text[k] for k in self._piece[at:self._name_end[at] + 1].tolist())
        own = int(self._ids[at])
        return SIGNS[own].decode() if own < len(SIGNS) else self.words.piece_text[int(self._piece[at])]

    def template_windows(self) -> tuple[np.ndarray, np.ndarray]:
        """(hash of every window, whether it may be evidence: in one text, with
        enough literal words)."""
        h, good = _windows(self.hash, self.text, WINDOW)
        slots = np.concatenate([[0], np.cumsum(self.place >= 0)])
        return h, good & (slots[WINDOW:][:len(h)] - slots[:len(h)] <= WINDOW - LITERALS)

    def plain_windows(self, width: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
        h, good = _windows(self.hash_of[self.plain], self.plain_text, width)
        if width < LITERALS:
            good &= self.opens[:len(h)] & self.closes[width - 1:][:len(h)]
        return h ^ _PLAIN[width], good

    def rows(self, plain: int, at: np.ndarray) -> tuple[list[str], list[list[str]]]:
        """Texts and slot values ("placeholder:value") of the windows at these
        places; ``plain`` is the width of plain windows, 0 for templates.  No
        template window begins with "="."""
        if plain:
            low = self.words.low
            return ["= " + b" ".join(map(low.__getitem__, self.plain[i:i + plain].tolist()))
                    .decode("utf-8", "replace") for i in at.tolist()], [[]] * len(at)
        texts, slots = [], []
        for i in at.tolist():
            words = [self.word(j) for j in range(i, i + WINDOW)]
            texts.append(b" ".join(words).decode("utf-8", "replace"))
            slots.append([f"{w.decode()}:{self.value(j)}" for j, w in enumerate(words, i) if self.place[j] >= 0])
        return texts, slots


def _windows(h: np.ndarray, text: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    total = h[:n] * _MULT[0]
    for i in range(1, width):
        total += h[i:i + n] * _MULT[i]
    total ^= total >> np.uint64(31)
    total *= _MULT[1]
    return total, text[:n] == text[width - 1:]


def template_words(text: str) -> list[bytes]:
    forms = Forms([text.encode()], Words())
    return [forms.word(i) for i in range(len(forms.source))]


def slot_values(text: str) -> list[str | None]:
    """For each template word its slot's value (None for literal words)."""
    forms = Forms([text.encode()], Words())
    return [forms.value(i) for i in range(len(forms.source))]


def slices(texts: list[bytes | None]) -> Iterator[tuple[int, list[bytes]]]:
    """(number of the first, texts) for about ``SLICE_BYTES`` at a time."""
    first, held, size = 0, [], 0
    for i, t in enumerate(texts):
        held.append(t or b"")
        size += len(t or b"")
        if size >= SLICE_BYTES:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


SLOTS = pa.list_(pa.string())


def item_windows(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, plain, n_windows, n_words, item_at, hash, window, item_slots);
    ``plain`` is the width of plain windows, 0 for templates."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for b in batches:
            for row, raw in enumerate(b.column(1).to_pylist()):
                forms = Forms([raw or b""], words)
                n = len(forms.plain)
                if not n:
                    continue
                width = min(WINDOW, n)
                kinds = [(width, *forms.plain_windows(width))]
                if width < WINDOW:  # matched whole, wherever its own text has breaks
                    kinds = [(width, kinds[0][1], np.ones(1, bool))]
                elif (forms.place >= 0).any():
                    kinds.append((0, *forms.template_windows()))
                for plain, h, good in kinds:
                    at = np.flatnonzero(good)
                    if not len(at):
                        continue
                    texts, slots = forms.rows(plain, at)
                    size = n if plain else len(forms.source)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array([row] * len(at))), pa.array([plain] * len(at), pa.int32()),
                         pa.array([len(at)] * len(at), pa.int64()), pa.array([size] * len(at), pa.int64()),
                         pa.array(at, pa.int64()), pa.array(h[at].view(np.int64)), pa.array(texts),
                         pa.array(slots, SLOTS)],
                        names=["item_id", "plain", "n_windows", "n_words", "item_at", "hash", "window", "item_slots"])

    narrow = items.select(F.col(id_col).alias("item_id"), text_bytes(text_col).alias("text"))
    kind = narrow.schema["item_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"item_id {kind}, plain int, n_windows long, n_words long, item_at long, "
                                  "hash long, window string, item_slots array<string>")


def bitmap(hashes: DataFrame) -> np.ndarray:
    """Bits of the windows' hashes, or-ed in Spark: 2**(BITMAP-6) words."""
    bit = F.shiftrightunsigned("hash", 64 - BITMAP)
    words = (hashes.select(F.shiftrightunsigned(bit, 6).alias("word"),
                           F.expr(f"shiftleft(1L, cast(shiftrightunsigned(hash, {64 - BITMAP}) & 63 as int))")
                           .alias("bits"))
             .groupBy("word").agg(F.bit_or("bits").alias("bits")).collect())
    out = np.zeros(1 << (BITMAP - 6), dtype=np.int64)
    for word, bits in words:
        out[word] = bits
    return out.view(np.uint64)


def candidate_windows(docs: DataFrame, bits: np.ndarray, widths: list[int], id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text_hash, doc_at, hash, window, doc_slots) of the windows
    whose bit is set; ``widths`` are the kinds of windows of the items."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, words = shared.value, Words()
        for b in batches:
            for first, texts in slices(b.column(2).to_pylist()):
                if len(words) > WORDS:
                    words = Words()
                forms = Forms(texts, words)
                for plain in widths:
                    h, good = forms.plain_windows(plain) if plain else forms.template_windows()
                    bit = h >> np.uint64(64 - BITMAP)
                    good &= (bits[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
                    at = np.flatnonzero(good)
                    if not len(at):
                        continue
                    out, slots = forms.rows(plain, at)
                    of = (forms.plain_text if plain else forms.text)[at]
                    row = pa.array(first + of)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(row), b.column(1).take(row), pa.array(at, pa.int64()),
                         pa.array(h[at].view(np.int64)), pa.array(out), pa.array(slots, SLOTS)],
                        names=["doc_id", "text_hash", "doc_at", "hash", "window", "doc_slots"])

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                         text_bytes(text_col).alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, text_hash long, doc_at long, hash long, "
                                  "window string, doc_slots array<string>")


def best_chain(pieces: list[dict], n_words: int, n_windows: int) -> tuple[int, int]:
    """(windows covered, slots changed) of the best chain.  Pieces are taken
    from the longest on; one joins the chain if it lies between the same
    neighbours in document and item, not further than ``n_words`` from one,
    and its slots agree with all so far."""
    pieces = [p | {"slots": {(s["item"], s["doc"]) for s in p["slots"]}} for p in pieces]
    pieces = [p for p in pieces if len({i for i, _ in p["slots"]}) == len(p["slots"])]
    pieces.sort(key=lambda p: (p["first"], p["diagonal"]))
    begins = [p["first"] for p in pieces]
    best = (0, 0)
    for seed in sorted(pieces, key=lambda p: (-p["n"], p["diagonal"])):
        if best[0] >= n_windows:
            break
        # A chain has at most n_words gaps' worth of room on either side; what
        # may join begins in this range (pieces are no longer than the item).
        reach = (n_words + 1) * n_words
        lo = bisect_left(begins, seed["first"] - reach)
        hi = bisect_right(begins, seed["last"] + reach)
        around = pieces[lo:hi]
        if sum(p["n"] for p in around) <= best[0]:
            continue
        chain, slots = [seed], dict(seed["slots"])
        for p in sorted(around, key=lambda p: (-p["n"], abs(p["diagonal"] - seed["diagonal"]), p["diagonal"])):
            apart = all((p["first"] > c["last"] and p["item_first"] > c["item_last"]) or
                        (p["last"] < c["first"] and p["item_last"] < c["item_first"]) for c in chain)
            near = any(p["first"] - c["last"] <= n_words and c["first"] - p["last"] <= n_words for c in chain)
            if apart and near and all(slots.get(i, d) == d for i, d in p["slots"]):
                chain.append(p)
                slots.update(p["slots"])
        covered = sum(p["n"] for p in chain)
        changed = sum(i != d for i, d in slots.items())
        best = max(best, (covered, -changed))
    return best[0], -best[1]


def chains(grouped: DataFrame) -> DataFrame:
    """``grouped`` with n_matched and changed_slots instead of its pieces."""
    others = [c for c in grouped.columns if c != "pieces"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [best_chain(*x) for x in zip(*(b.column(c).to_pylist() for c in (
                "pieces", "n_words", "n_windows")), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in others), pa.array([x for x, _ in found], pa.int64()),
                 pa.array([x for _, x in found], pa.int32())], names=[*others, "n_matched", "changed_slots"])

    schema = ", ".join(f"{c} {grouped.schema[c].dataType.simpleString()}" for c in others)
    return grouped.mapInArrow(run, f"{schema}, n_matched long, changed_slots int")


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id_col: str = "item_id", item_text_col: str = "text",
                 coverage: float = COVERAGE) -> DataFrame:
    """One row per document and item it holds: doc_id, text_hash, item_id,
    n_matched, n_windows, coverage, changed_slots and kind."""
    wanted = saved(item_windows(items, item_id_col, item_text_col))
    widths = sorted(r["plain"] for r in wanted.select("plain").distinct().collect())
    found = candidate_windows(docs, bitmap(wanted.select("hash")), widths, id_col, text_col)
    pairs = (found.join(wanted.withColumnRenamed("hash", "_h").withColumnRenamed("window", "_w"),
                        (F.col("hash") == F.col("_h")) & (F.col("window") == F.col("_w")))
             .withColumn("slots", F.transform(F.arrays_zip("item_slots", "doc_slots"), lambda s: F.struct(
                 s["item_slots"].alias("item"), s["doc_slots"].alias("doc")))))
    key = ["doc_id", "text_hash", "item_id", "plain", "n_windows", "n_words"]
    pieces = (pairs.groupBy(*key, (F.col("doc_at") - F.col("item_at")).alias("diagonal"))
              .agg(F.count_distinct("item_at").alias("n"), F.min("doc_at").alias("first"),
                   F.max("doc_at").alias("last"), F.min("item_at").alias("item_first"),
                   F.max("item_at").alias("item_last"),
                   F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots")))
    grouped = (pieces.groupBy(*key).agg(
        F.sum("n").alias("all"), F.collect_list(F.struct(
            "diagonal", "n", "first", "last", "item_first", "item_last", "slots")).alias("pieces"))
        .where(F.col("all") >= F.col("n_windows") * coverage).drop("all"))
    share = F.col("n_matched") / F.col("n_windows")
    held = (chains(grouped).withColumn("coverage", share).where(F.col("coverage") >= coverage)
            .withColumn("other", ((F.col("plain") == 0) & (F.col("changed_slots") > 0)).cast("int")))
    # Other slot values count before plain windows beside them do.
    best = held.groupBy("doc_id", "text_hash", "item_id").agg(F.max(F.struct(
        "other", "coverage", (-F.col("changed_slots")).alias("same"), "n_windows", "n_matched",
        "changed_slots")).alias("best"))
    return (best.select("doc_id", "text_hash", "item_id", "best.*")
            .select("doc_id", "text_hash", "item_id", "n_matched", "n_windows", "coverage", "changed_slots",
                    F.when(F.col("changed_slots") == 0, "verbatim").otherwise("reparameterised").alias("kind")))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The documents that hold no item, columns unchanged."""
    hits = (contaminated(docs, items, id_col, text_col, item_id_col, item_text_col)
            .select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h")).distinct())
    packed = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_id"),
                         F.xxhash64(text_col).alias("_hash"))
    clean = packed.join(hits, F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_hash") == F.col("_h")), "left_anti")
    return clean.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
