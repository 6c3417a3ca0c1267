"""License scan by template markup.

A template is the normalised wording of a license notice with marked regions:
``<<beginOptional>>`` ... ``<<endOptional>>`` may be absent, and
``<<var;match=a|b>>`` (one of these wordings) or ``<<var;max=n>>`` (one to n
words) may be replaced.  Every template is compiled into a token automaton; a
place is accepted if the automaton, started at one of the text's words, reaches
its end, that is, if the mandatory wording stands there exactly, in order, and
the rest fits the marked regions.

``license_notices`` holds whole notices, conditions and disclaimers included (a
text that changes one mandatory word of them is no such notice), and one-sentence
statements that name a license; ``notices`` and the score tell them apart.

Words are runs of digits, ASCII letters (lower-cased) and characters beyond
ASCII.  Next to the templates the three base phrases are counted.

Scale.  One pass over whole texts, no shuffle; an automaton only starts where a
template can begin, in texts that hold all its mandatory words.

Edge cases.  Null and empty texts have no words, no places (null positions),
empty labels and score 0.  Repeated rows are scanned alike.  An empty table
gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from quarry.llm.common import map_texts
from quarry.llm.license_notices import NOTICES, STATEMENTS

# The base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: What is looked for: (label, wording, whole notice or one-sentence statement).
TEMPLATES = tuple((label, markup, whole) for whole, texts in ((True, NOTICES), (False, STATEMENTS))
                  for label, markup in texts)

WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c > 127 else 32
                   for c in range(256))
#: Scores of a text with a whole notice, else with a statement, else with a base phrase.
NOTICE_SCORE, STATEMENT_SCORE, BASE_SCORE = 1.0, 0.75, 0.5


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(WORD_BYTES).split()


def parse(markup: str) -> list:
    """Nested regions: a word, ("opt", items), ("one", wordings) or ("any", n);
    a wording is a list of words."""
    stack: list[list] = [[]]
    for k, part in enumerate(re.split("<<(.*?)>>", markup, flags=re.S)):
        if k % 2 == 0:
            stack[-1].extend(words_of(part.encode()))
        elif part == "beginOptional":
            stack.append([])
        elif part == "endOptional" and len(stack) > 1:
            inner = stack.pop()
            stack[-1].append(("opt", inner))
        elif part.startswith("var;match="):
            stack[-1].append(("one", [words_of(x.encode()) for x in part[len("var;match="):].split("|")]))
        elif part.startswith("var;max="):
            stack[-1].append(("any", int(part[len("var;max="):])))
        else:
            raise ValueError(f"unknown or unbalanced region {part!r}")
    if len(stack) != 1:
        raise ValueError("unbalanced optional region")
    return stack[0]


@dataclass
class Automaton:
    """States with word steps and any-word steps, free of empty steps."""

    words: list[dict[bytes, set[int]]] = field(default_factory=list)
    wild: list[set[int]] = field(default_factory=list)
    final: set[int] = field(default_factory=set)
    start: frozenset[int] = frozenset()

    @classmethod
    def of(cls, items: list) -> Automaton:
        m = cls()
        ends = m._add(items, {m._state()})
        m.start, m.final = frozenset({0}), ends
        return m

    def _state(self) -> int:
        self.words.append({})
        self.wild.append(set())
        return len(self.words) - 1

    def _add(self, items: list, at: set[int]) -> set[int]:
        """Append the items after the states ``at``; the states they end in."""
        for item in items:
            if isinstance(item, bytes):
                new = self._state()
                for s in at:
                    self.words[s].setdefault(item, set()).add(new)
                at = {new}
            elif item[0] == "one":
                at = set().union(*(self._add(wording, at) for wording in item[1]))
            elif item[0] == "opt":
                at = at | self._add(item[1], at)
            else:
                ends: set[int] = set()
                for _ in range(item[1]):
                    new = self._state()
                    for s in at:
                        self.wild[s].add(new)
                    at = {new}
                    ends.add(new)
                at = ends
        return at

    def accepts(self, words: list[bytes], at: int) -> bool:
        """Whether some run from the word at ``at`` reaches the end."""
        states = set(self.start)
        while states:
            if not states.isdisjoint(self.final):
                return True
            if at == len(words):
                return False
            w = words[at]
            states = {n for s in states for n in (*self.words[s].get(w, ()), *self.wild[s])}
            at += 1
        return False


@dataclass
class Template:
    label: str
    whole: bool
    automaton: Automaton
    must: frozenset[bytes]  # words no accepted place lacks

    @classmethod
    def of(cls, label: str, markup: str, whole: bool) -> Template:
        items = parse(markup)
        m = Automaton.of(items)
        if m.wild[0] or 0 in m.final:
            raise ValueError(f"{label}: a template starts with a word")
        return cls(label, whole, m, frozenset(x for x in items if isinstance(x, bytes)))


def compiled(templates=TEMPLATES) -> list[Template]:
    return [Template.of(*t) for t in templates]


def places(words: list[bytes], target: bytes) -> list[int]:
    found, at = [], -1
    try:
        while True:
            at = words.index(target, at + 1)
            found.append(at)
    except ValueError:
        return found


def base_places(words: list[bytes]) -> list[tuple[int, str]]:
    """(start, label) of every base phrase."""
    out = []
    by_last: dict[bytes, list[tuple[list[bytes], str]]] = {}
    for phrase, label in BASE.items():
        p = phrase.encode().split()
        by_last.setdefault(p[-1], []).append((p, label))
    for last, phrases in by_last.items():
        for at in places(words, last):
            for p, label in phrases:
                start = at - len(p) + 1
                if start >= 0 and words[start:at + 1] == p:
                    out.append((start, label))
    return out


def scan(words: list[bytes], templates: list[Template]) -> tuple[set[str], set[str]]:
    """Labels of the templates accepted anywhere: all, and of whole notices."""
    found: set[tuple[str, bool]] = set()
    have = set(words)
    for t in templates:
        if (t.label, t.whole) not in found and t.must <= have and any(
                t.automaton.accepts(words, at) for w in t.automaton.words[0] for at in places(words, w)):
            found.add((t.label, t.whole))
    return {x for x, _ in found}, {x for x, whole in found if whole}


def scan_licenses(docs: DataFrame, keep: dict[str, Column], text_col: str = "text",
                  templates=TEMPLATES) -> DataFrame:
    """Kept columns with n_words, n_base, first_word, last_word, base_labels,
    labels, templates (labels the automata gave), notices (those of whole
    notices) and score."""
    held: dict[str, list[Template]] = {}

    def run(texts: list) -> dict:
        if "m" not in held:
            held["m"] = compiled(templates)
        out = []
        for t in texts:
            words = words_of(t)
            base = base_places(words)
            own, notices = scan(words, held["m"])
            at = [s for s, _ in base]
            base_labels = {x for _, x in base}
            out.append((len(words), len(base), min(at, default=None), max(at, default=None),
                        ",".join(sorted(base_labels)), ",".join(sorted(base_labels | own)),
                        ",".join(sorted(own)), ",".join(sorted(notices)),
                        NOTICE_SCORE if notices else STATEMENT_SCORE if own else BASE_SCORE if base else 0.0))
        cols = list(zip(*out, strict=True))
        return {"n_words": np.array(cols[0], np.int64), "n_base": np.array(cols[1], np.int64),
                "first_word": pa.array(cols[2], pa.int64()), "last_word": pa.array(cols[3], pa.int64()),
                "base_labels": pa.array(cols[4], pa.string()), "labels": pa.array(cols[5], pa.string()),
                "templates": pa.array(cols[6], pa.string()), "notices": pa.array(cols[7], pa.string()),
                "score": np.array(cols[8], np.float64)}

    return map_texts(docs, text_col, keep, run,
                     "n_words long, n_base long, first_word long, last_word long, "
                     "base_labels string, labels string, templates string, notices string, score double")
