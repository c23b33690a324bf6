"""License scans: template-markup matching with token automata.

A licence notice is written as a template. Words outside markup are mandatory; ``[[ ... ]]``
encloses an optional region; ``{{name:n}}`` is a replaceable region of 0 to n words;
``(( a || b ))`` is a choice. A template compiles to a nondeterministic automaton over
words, which accepts a run of words only when every mandatory word matches exactly. A
scan starts an automaton at each place where a word can begin a template and reports the
longest accepted run.

Base places are phrases whose words stand consecutively. Score: 1 when a template
accepts, 0.5 for base phrases alone, 0 otherwise.

Defined cases: a null or empty text has no words and no labels (first_word, last_word
null, score 0). Texts of any length are read whole, in blocks of bounded bytes; places of
all phrases count, also overlapping ones. Repeated rows and ties give a row each; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import blocks, ready, texts, utf8

#: Base phrases and their labels (fixed values).
PHRASES = {b"mit license": "mit", b"apache license": "apache", b"general public license": "gpl"}
#: Notices of public licences as templates.
TEMPLATES = {
    "Apache-2.0": "[[ this {{work:3}} is ]] licensed under the apache license [[ version ]] 2 0",
    "Apache-2.0-header": "licensed under the apache license version 2 0 [[ the license ]] you may not use this "
                         "{{file:3}} except in compliance with the license",
    "MIT": "(( released || licensed || distributed || available )) under the [[ terms of the ]] mit license",
    "MIT-text": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                "associated documentation files",
    "GPL-3.0": "[[ this {{work:4}} is ]] licensed under the gnu general public license [[ as published by the free "
               "software foundation ]] [[ either ]] version 3 [[ or any later version ]]",
    "GPL-2.0": "[[ this {{work:4}} is ]] licensed under the gnu general public license [[ either ]] version 2 "
               "[[ or any later version ]]",
    "CC-BY-NC-4.0": "licensed under [[ a ]] (( cc || creative commons )) (( by nc || attribution noncommercial )) 4 0",
    "BSD-3-Clause": "redistribution and use in source and binary forms with or without modification are permitted "
                    "provided that the following conditions are met",
}
_KEEP = bytes(range(48, 58)) + bytes(range(97, 123)) + bytes(range(128, 256))
#: Bytes that are no part of a word become blanks; ASCII capitals become small.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b in _KEEP else 32 for b in range(256))
SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double, matches array<struct<label:string,first:long,end:long>>")

Arcs = list[tuple["bytes | None", int]]  # (word, target); None: any word


class Automaton:
    """Token automaton of one template: arcs on words, empty moves, one accepting state."""

    def __init__(self, template: str):
        self.arcs: list[Arcs] = [[]]
        self.empty: list[list[int]] = [[]]
        parts = re.findall(r"\[\[|\]\]|\(\(|\)\)|\|\||\{\{\w+:\d+\}\}|[^\s\[\](){}|]+", template)
        self.accept, rest = self._sequence(parts, 0)
        if rest:
            raise ValueError(f"unbalanced markup in template: {rest[0]}")
        self.start = frozenset(self._close({0}))
        self.first = {w for s in self.start for w, _ in self.arcs[s]}
        if None in self.first or self.accept in self.start:
            raise ValueError("a template must begin with a mandatory or optional word")

    def _state(self) -> int:
        self.arcs.append([])
        self.empty.append([])
        return len(self.arcs) - 1

    def _sequence(self, parts: list[str], at: int) -> tuple[int, list[str]]:
        """Compile parts from state ``at`` up to a closing mark; (last state, what is left)."""
        while parts and parts[0] not in ("]]", "))", "||"):
            part, parts = parts[0], parts[1:]
            if part == "[[":
                end, parts = self._sequence(parts, at)
                self.empty[at].append(end)
                at, parts = end, self._closed(parts, "]]")
            elif part == "((":
                ends, fork = [], at
                while True:
                    branch = self._state()
                    self.empty[fork].append(branch)
                    end, parts = self._sequence(parts, branch)
                    ends.append(end)
                    if not parts or parts[0] != "||":
                        break
                    parts = parts[1:]
                parts, at = self._closed(parts, "))"), self._state()
                for end in ends:
                    self.empty[end].append(at)
            elif part.startswith("{{"):
                for _ in range(int(part[2:-2].split(":")[1])):
                    after = self._state()
                    self.arcs[at].append((None, after))
                    self.empty[at].append(after)
                    at = after
            else:
                after = self._state()
                self.arcs[at].append((part.encode(), after))
                at = after
        return at, parts

    @staticmethod
    def _closed(parts: list[str], mark: str) -> list[str]:
        if not parts or parts[0] != mark:
            raise ValueError(f"missing {mark} in template")
        return parts[1:]

    def _close(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for s in self.empty[todo.pop()]:
                if s not in states:
                    states.add(s)
                    todo.append(s)
        return states

    def longest(self, words: list[bytes], at: int) -> int:
        """End of the longest accepted run that starts at ``at``, or -1."""
        states, end = set(self.start), -1
        for i in range(at, len(words)):
            word = words[i]
            states = self._close({t for s in states for w, t in self.arcs[s] if w is None or w == word})
            if not states:
                break
            if self.accept in states:
                end = i + 1
        return end


class Scanner:
    """All templates and phrases; ``scan`` gives base places and accepted runs of a text."""

    def __init__(self, templates: dict[str, str] | None = None):
        self.automata = {name: Automaton(t) for name, t in (templates or TEMPLATES).items()}
        self.by_first: dict[bytes, list[tuple[str, Automaton]]] = {}
        for name, a in self.automata.items():
            for word in a.first:
                self.by_first.setdefault(word, []).append((name, a))
        self.phrases = [(tuple(p.split()), label) for p, label in PHRASES.items()]
        #: Every phrase has this word, and so every place is found by looking at it.
        self.last = {p[-1] for p, _ in self.phrases}

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, str]], list[tuple[str, int, int]]]:
        places, runs = [], []
        for at, word in enumerate(words):
            if word in self.last:
                for phrase, label in self.phrases:
                    first = at + 1 - len(phrase)
                    if first >= 0 and tuple(words[first:at + 1]) == phrase:
                        places.append((first, label))
            for name, a in self.by_first.get(word, ()):
                end = a.longest(words, at)
                if end > 0:
                    runs.append((name, at, end))
        return places, runs


def scan_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scanner = Scanner()
    starts = set(scanner.by_first) | scanner.last
    kind = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64())]))
    for table in blocks(batches):
        rows = []
        for text in utf8(table):
            words = text.translate(WORD_BYTES).split()
            places, runs = scanner.scan(words) if not starts.isdisjoint(words) else ([], [])
            base = sorted({label for _, label in places})
            found = sorted({*base, *(name for name, _, _ in runs)})
            rows.append((len(words), len(places), min((p for p, _ in places), default=None),
                         max((p for p, _ in places), default=None), ",".join(base), ",".join(found),
                         1.0 if runs else 0.5 if places else 0.0,
                         [{"label": n, "first": a, "end": e} for n, a, e in runs]))
        n, b, f, las, bl, lab, score, found = zip(*rows)
        yield pa.RecordBatch.from_arrays(
            [table.column("doc_id").combine_chunks(), pa.array(n, pa.int64()), pa.array(b, pa.int64()),
             pa.array(f, pa.int64()), pa.array(las, pa.int64()), pa.array(bl, pa.string()), pa.array(lab, pa.string()),
             pa.array(score, pa.float64()), pa.array(found, kind)],
            names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"])


def license_scan(docs: DataFrame) -> DataFrame:
    """One row per document with word count, base places, labels, score and ``matches``
    (label, first word, end word of every accepted run)."""
    ready(docs.sparkSession)
    return texts(docs).mapInArrow(scan_batches, SCHEMA)
