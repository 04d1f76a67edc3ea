"""License scans: templates with markup, compiled into automata over words.

A template is the wording of a license or of a notice.  What stands outside of markup is mandatory and has to match
word for word; ``<<beginOptional>>`` ... ``<<endOptional>>`` may be left out, regions nest, and ``<<var;...>>`` is
replaceable: with ``words="2-5"`` by any two to five words, with ``match="a|b c"`` by one of the
alternatives.  Case, punctuation and white space do not count, because words are compared.

Each template becomes a non-deterministic automaton whose letters are words.  It starts at every word that can
begin it, and a passage is found if the automaton accepts it; from one start the longest passage counts.
A text that lacks a template's rarest kind of word, its longest mandatory one, cannot match and is not walked.

Beside the templates there are plain phrases, found wherever their words stand consecutively.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from orderline_kpi.llm.common import filled

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_MARKUP = re.compile(r"<<(beginOptional|endOptional|var;[^>]*)>>")
_RANGE = re.compile(r'words="(\d+)-(\d+)"')
_MATCH = re.compile(r'match="([^"]*)"')

#: Plain phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: The wording of public licenses and of the notices that name them.
TEMPLATES = {
    "mit-notice": '<<beginOptional>><<var;match="released|licensed|distributed|available|published">><<endOptional>> '
                  "under the <<beginOptional>>terms of the<<endOptional>> MIT License",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of "
                '<<var;words="1-6">> and associated documentation files (the "Software"), to deal in the Software without '
                "restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, "
                "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to "
                "do so, subject to the following conditions: The above copyright notice and this permission notice "
                "<<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or "
                "substantial portions of the Software.",
    "apache-2.0-notice": 'Licensed under the Apache License, Version <<var;match="2.0|2">>'
                         '<<beginOptional>> (the "License"); you may not use this file except in compliance with the License'
                         "<<endOptional>>",
    "gpl-notice": '<<beginOptional>>This <<var;match="program|work|library|file">><<endOptional>> is '
                  "<<beginOptional>>free software and is<<endOptional>> licensed under the GNU "
                  '<<beginOptional>><<var;match="Lesser|Affero">><<endOptional>> General Public License'
                  '<<beginOptional>>, version <<var;match="1|2|3|2.0|3.0|2.1">><<endOptional>>',
    "gpl-text": "This program is free software<<beginOptional>>;<<endOptional>> you can redistribute it and/or modify it "
                "under the terms of the GNU General Public License as published by the Free Software Foundation; "
                '<<beginOptional>>either<<endOptional>> version <<var;match="2|3">>',
    "cc-notice": 'Licensed under <<beginOptional>>a Creative Commons<<endOptional>> <<beginOptional>>CC<<endOptional>> '
                 '<<var;match="BY|BY-SA|BY-NC|BY-ND|BY-NC-SA|BY-NC-ND">> <<var;match="1.0|2.0|2.5|3.0|4.0">>',
    "bsd-text": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                "provided that the following conditions are met",
    "isc-text": "Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any "
                "purpose with or without fee is hereby granted, provided that the above copyright notice and this "
                "permission notice appear in all copies",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}


def words_of(text: str) -> list[bytes]:
    """The words of a text: runs of ASCII letters, lower-cased, digits and all other characters than ASCII."""
    return WORD.findall(text.encode("utf-8").lower())


@dataclass
class TokenAutomaton:
    """An automaton over words; state 0 begins, ``accepting`` states end a passage."""

    moves: list[dict[bytes, set[int]]] = field(default_factory=lambda: [{}])
    anything: list[set[int]] = field(default_factory=lambda: [set()])
    silent: list[set[int]] = field(default_factory=lambda: [set()])
    end: int = 0
    mandatory: set[bytes] = field(default_factory=set)

    def state(self) -> int:
        for table, empty in ((self.moves, {}), (self.anything, set()), (self.silent, set())):
            table.append(empty)
        return len(self.moves) - 1

    def closure(self, states: set[int]) -> frozenset[int]:
        found, open_ = set(states), list(states)
        while open_:
            fresh = self.silent[open_.pop()] - found
            found |= fresh
            open_ += fresh
        return frozenset(found)

    def finish(self) -> TokenAutomaton:
        self.begin = self.closure({0})
        self.first = {word for state in self.begin for word in self.moves[state]}
        if any(self.anything[state] for state in self.begin) or self.end in self.begin:
            raise ValueError("a template has to begin with a word of its own")
        #: Text without this word holds no passage.
        self.key = max(self.mandatory, key=lambda word: (len(word), word))
        self.known: dict[tuple[frozenset[int], bytes], frozenset[int]] = {}
        self.letters = {word for table in self.moves for word in table}
        return self

    def step(self, states: frozenset[int], word: bytes) -> frozenset[int]:
        """The states behind ``word``; sets that come again are looked up, and words of no template count as one."""
        seen = states, word if word in self.letters else b""
        if seen not in self.known:
            reached: set[int] = set()
            for state in states:
                reached |= self.moves[state].get(word, set()) | self.anything[state]
            self.known[seen] = self.closure(reached)
        return self.known[seen]

    def longest(self, words: list[bytes], start: int) -> int:
        """The end of the longest passage from ``start``, or -1."""
        states, found = self.begin, -1
        for at in range(start, len(words)):
            states = self.step(states, words[at])
            if not states:
                break
            if self.end in states:
                found = at + 1
        return found


def compile_template(template: str) -> TokenAutomaton:
    """The automaton of a template with markup."""
    automaton, at = TokenAutomaton(), 0
    opened: list[int] = []

    def path(begin: int, words: list[bytes]) -> int:
        for word in words:
            after = automaton.state()
            automaton.moves[begin].setdefault(word, set()).add(after)
            begin = after
        return begin

    for k, part in enumerate(_MARKUP.split(template)):
        if k % 2 == 0:
            words = words_of(part)
            automaton.mandatory.update(words if not opened else ())
            at = path(at, words)
        elif part == "beginOptional":
            opened.append(at)
            begin, at = at, automaton.state()
            automaton.silent[begin].add(at)
        elif part == "endOptional":
            after = automaton.state()
            automaton.silent[at].add(after)
            automaton.silent[opened.pop()].add(after)
            at = after
        elif found := _RANGE.search(part):
            low, high = map(int, found.groups())
            after = automaton.state()
            for n in range(high + 1):
                if n >= low:
                    automaton.silent[at].add(after)
                if n < high:
                    following = automaton.state()
                    automaton.anything[at].add(following)
                    at = following
            at = after
        elif found := _MATCH.search(part):
            after = automaton.state()
            for choice in found[1].split("|"):
                automaton.silent[path(at, words_of(choice))].add(after)
            at = after
        else:
            raise ValueError(f"unknown markup: {part}")
    if opened or not automaton.mandatory:
        raise ValueError("an optional region is open, or nothing is mandatory")
    automaton.end = at
    return automaton.finish()


def template_pattern(template: str) -> str:
    """The same template as a regular expression over words with a space behind each, for engines that have no automata."""
    out = []
    for k, part in enumerate(_MARKUP.split(template)):
        if k % 2 == 0:
            out += [word.decode() + " " for word in words_of(part)]
        elif part == "beginOptional":
            out.append("(?:")
        elif part == "endOptional":
            out.append(")?")
        elif found := _RANGE.search(part):
            out.append("(?:[^ ]+ ){%s,%s}" % found.groups())
        else:
            choices = _MATCH.search(part)[1].split("|")
            out.append("(?:" + "|".join("".join(word.decode() + " " for word in words_of(c)) for c in choices) + ")")
    return "".join(out)


def phrase_places(joined: bytes, phrase: bytes) -> list[int]:
    """The numbers of the words at which ``phrase`` begins; ``joined``: words with a space before and behind each."""
    places, needle, words, before = [], b" " + phrase + b" ", 0, 0
    at = joined.find(needle)
    while at >= 0:
        words += joined.count(b" ", before, at)
        places.append(words)
        before = at
        at = joined.find(needle, at + 1)
    return places


class Scanner:
    """Phrases and compiled templates, ready to read texts."""

    def __init__(self, phrases: Mapping[str, str], templates: Mapping[str, str]) -> None:
        self.phrases = [(b" ".join(words_of(phrase)), label) for phrase, label in phrases.items()]
        self.automata = {label: compile_template(template) for label, template in templates.items()}

    def scan(self, text: str) -> tuple[int, list[tuple[str, bool, int, int]]]:
        """The number of words, and all places: label, whether of a phrase, first word, end."""
        lower = text.encode("utf-8").lower()
        words = WORD.findall(lower)
        places: list[tuple[str, bool, int, int]] = []
        joined = None
        for phrase, label in self.phrases:
            if phrase[:phrase.find(b" ")] in lower:
                joined = joined or b" " + b" ".join(words) + b" "
                size = phrase.count(b" ") + 1
                places += [(label, True, at, at + size) for at in phrase_places(joined, phrase)]
        for label, automaton in self.automata.items():
            if automaton.key in lower:
                for at, word in enumerate(words):
                    if word in automaton.first and (end := automaton.longest(words, at)) >= 0:
                        places.append((label, False, at, end))
        places.sort(key=lambda place: (place[2], place[3], place[0]))
        return len(words), places


_PLACES = "array<struct<label:string,phrase:boolean,start:long,end:long>>"
_ARROW_PLACES = pa.list_(pa.struct([
    ("label", pa.string()), ("phrase", pa.bool_()), ("start", pa.int64()), ("end", pa.int64())]))


def scan_licenses(
    docs: DataFrame, columns: list[str], text_column: str = "text",
    phrases: Mapping[str, str] = PHRASES, templates: Mapping[str, str] = TEMPLATES,
) -> DataFrame:
    """``columns`` of each row of ``docs`` with ``n_words`` and ``places``.

    A place has a label, whether a phrase or a template found it, its first word and the end behind its last one,
    counted from 0; places are in the order of start, end and label.  Null and empty texts have no words and no
    places.  Every row is read by itself, so repeated rows give equal results and there are no ties.  Texts
    are read whole, one at a time; columns may have any names.  An empty table gives an empty result.
    """
    rows = docs.select(*[F.col(c).alias(f"c{k}") for k, c in enumerate(columns)], filled(F.col(text_column)).alias("text"))
    kept = [f"c{k}" for k in range(len(columns))]
    types = "".join(f"{c} {rows.schema[c].dataType.simpleString()}, " for c in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(phrases, templates)
        names = ("label", "phrase", "start", "end")
        for batch in batches:
            found = [scanner.scan(text) for text in batch.column("text").to_pylist()]
            places = [[dict(zip(names, place, strict=True)) for place in places] for _, places in found]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in kept), pa.array([n for n, _ in found], pa.int64()), pa.array(places, _ARROW_PLACES)],
                [*kept, "n_words", "places"])

    found = rows.mapInArrow(run, f"{types}n_words long, places {_PLACES}")
    return found.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(columns)], "n_words", "places")
