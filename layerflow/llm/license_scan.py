"""Licence scans of whole texts.

One Aho-Corasick automaton runs over each text's normalised words (A-Z lower-cased, everything that is
no ASCII letter, digit or non-ASCII character taken for a separator) and finds, in one pass, the base
phrases, longer notice phrases and identifier tags. A shunting-yard parser evaluates the licence
expression behind every identifier tag (``or``, ``and``, ``with``, parentheses) to the labels it names
and to whether some choice of it is permissive only.

Results for special input: null and empty texts have no words, no places, null first and last words,
empty labels and score 0; a broken expression counts up to its first error; invalid UTF-8 stays as it is
(bytes above 0x7F are word characters); repeated rows give repeated results; an empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_and_bytes, map_rows, worker_model

# The base phrases and their labels.
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Notice phrases of public licences, as normalised words, and their labels.
NOTICE_PHRASES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "released under the mit license": "mit",
    "licensed under the mit license": "mit",
    "licensed under the apache license": "apache",
    "apache software license": "apache",
    "gnu general public license": "gpl",
    "gnu gpl": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu library general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "2 clause bsd": "bsd",
    "3 clause bsd": "bsd",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "european union public licence": "eupl",
    "permission to use copy modify and or distribute this software": "isc",
    "isc license": "isc",
    "boost software license": "bsl",
    "artistic license": "artistic",
    "zlib license": "zlib",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "released into the public domain": "public-domain",
    "dedicated to the public domain": "public-domain",
    "creative commons zero": "cc0",
    "cc0 1 0": "cc0",
    "licensed under cc by": "cc-by",
    "licensed under cc by sa": "cc-by-sa",
    "licensed under cc by nc": "cc-by-nc",
    "licensed under cc by nd": "cc-by-nd",
    "licensed under cc by nc sa": "cc-by-nc-sa",
    "licensed under cc by nc nd": "cc-by-nc-nd",
    "creative commons attribution": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution share alike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution non commercial": "cc-by-nc",
    "all rights reserved": "all-rights-reserved",
}

# Words of an identifier tag, and how identifiers begin, longest first, with their labels.
TAG_WORDS = "spdx license identifier"
FAMILIES = (
    ("cc-by-nc-nd", "cc-by-nc-nd"), ("cc-by-nc-sa", "cc-by-nc-sa"), ("cc-by-nc", "cc-by-nc"), ("cc-by-nd", "cc-by-nd"),
    ("cc-by-sa", "cc-by-sa"), ("unlicense", "unlicense"), ("artistic", "artistic"), ("apache", "apache"),
    ("cc-by", "cc-by"), ("agpl", "agpl"), ("lgpl", "lgpl"), ("eupl", "eupl"), ("zlib", "zlib"), ("gpl", "gpl"),
    ("bsd", "bsd"), ("mpl", "mpl"), ("epl", "epl"), ("isc", "isc"), ("mit", "mit"), ("bsl", "bsl"), ("cc0", "cc0"),
)
# How further public identifiers begin; their label is that beginning.
OTHER_IDENTIFIERS = (
    "0bsd afl apsl blueoak cddl cecill cpl curl ecl epl-1.0 fsfap gfdl hpnd icu ijg libpng lppl ms-pl ms-rl ncsa nposl oclc odbl ofl"
    " openssl osl php pddl postgresql psf python qpl rpl ruby sissl sleepycat tcl unicode upl vim w3c wtfpl x11 zpl").split()
PERMISSIVE = frozenset("mit apache bsd isc zlib bsl unlicense cc0 cc-by artistic public-domain".split())

#: Weight of one piece of evidence of each kind; the score is 1 - the product of (1 - weight) over the evidence.
WEIGHTS = {"base": 0.3, "notice": 0.6, "tag": 0.9}

_TO_WORDS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)
_TAG = re.compile(rb"(?i)spdx[^0-9a-z\x80-\xff]+license[^0-9a-z\x80-\xff]+identifier[\x20\t]*:?[\x20\t]*([^\r\n]*)")
_TOKEN = re.compile(rb"\s*([A-Za-z0-9.+:-]+|[()])")
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}


def family(identifier: str) -> str | None:
    """Label of a licence identifier: its family's, or its own for ``LicenseRef-…``; None if it is none. A beginning counts
    if no further letter but a version's ``v`` follows."""
    low = identifier.lower()
    for start, label in (*FAMILIES, *((x, x) for x in OTHER_IDENTIFIERS)):
        if low.startswith(start) and re.match(r"$|[^a-z]|v\d", low[len(start):]):
            return label
    if low.startswith(("licenseref-", "documentref-")):
        return low.strip(":+.")
    return None


def _is_exception(word: str) -> bool:
    return "exception" in word or word.endswith("-note") or word.startswith("additionref-")


def postfix(expression: bytes) -> list[str]:
    """Shunting-yard: the longest well-formed beginning of an expression, operators behind their operands. It ends at the
    first operand that is no licence identifier (behind ``with``: no exception)."""
    out: list[str] = []
    waiting: list[str] = []
    best: list[str] = []
    at, operand_next = 0, True
    while m := _TOKEN.match(expression, at):
        token, at = m[1].decode(), m.end()
        low = token.lower()
        if operand_next:
            if token == "(":
                waiting.append(token)
                continue
            known = _is_exception(low) if waiting[-1:] == ["with"] else family(low)
            if token == ")" or low in _PRECEDENCE or not known:
                break
            out.append(token)
            operand_next = False
        elif low in _PRECEDENCE:
            while waiting and waiting[-1] != "(" and _PRECEDENCE[waiting[-1]] >= _PRECEDENCE[low]:
                out.append(waiting.pop())
            waiting.append(low)
            operand_next = True
            continue
        elif token == ")" and "(" in waiting:
            while (top := waiting.pop()) != "(":
                out.append(top)
        else:
            break
        if not operand_next:  # complete, if what waits is closed here
            best = out + [w for w in reversed(waiting) if w != "("]
    return best


def evaluate(expression: bytes) -> tuple[set[str], bool]:
    """Labels that a licence expression names, and whether some choice of it is permissive only."""
    stack: list[tuple[set[str], bool]] = []
    for token in postfix(expression):
        if token not in _PRECEDENCE:
            label = family(token)
            stack.append(({label} if label else set(), label in PERMISSIVE))  # an exception has no label
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with":  # an exception adds to what the licence permits; it is no licence
            stack.append(left)
        elif token == "and":
            stack.append((left[0] | right[0], left[1] and right[1]))
        else:
            stack.append((left[0] | right[0], left[1] or right[1]))
    return stack[-1] if stack else (set(), False)


class Scanner:
    def __init__(self):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        kinds: dict[str, list[tuple[str, str]]] = {}
        for kind, phrases in (("base", BASE_PHRASES), ("notice", NOTICE_PHRASES), ("tag", {TAG_WORDS: ""})):
            for phrase, label in phrases.items():
                kinds.setdefault(f" {phrase} ", []).append((kind, label))
        for phrase, found in kinds.items():
            self.automaton.add_word(phrase, (len(phrase), found))
        self.automaton.make_automaton()

    def scan(self, body: bytes) -> tuple:
        """n_words, n_base, first_word, last_word, base_labels, labels, score, n_tags, permissive."""
        words = body.translate(_TO_WORDS).split()
        text = f" {b' '.join(words).decode('latin-1')} "
        starts, base, notices, tags = [], set(), [], 0
        for end, (length, found) in self.automaton.iter(text):
            start = end - length + 1
            for kind, label in found:
                if kind == "base":
                    starts.append(start)
                    base.add(label)
                elif kind == "notice":
                    notices.append((start, end, label))
                else:
                    tags += 1
        if not (starts or notices or tags):
            return len(words), 0, None, None, "", "", 0.0, 0, None
        # A notice inside a longer one that begins with it or before it says nothing of its own.
        notices.sort(key=lambda x: (x[0], -x[1]))
        outer, reach = [], -1
        for start, end, label in notices:
            if end > reach:
                outer.append(label)
                reach = end
        labels, permissive, parsed = base | set(outer), None, 0
        if tags:
            for m in _TAG.finditer(body):
                named, free = evaluate(m[1])
                labels |= named
                permissive = free if permissive is None else permissive and free
                parsed += bool(named)
        left = (1 - WEIGHTS["base"]) ** len(starts) * (1 - WEIGHTS["notice"]) ** len(outer) * (1 - WEIGHTS["tag"]) ** parsed
        place = [text.count(" ", 0, s) for s in (min(starts), max(starts))] if starts else [None, None]
        return (len(words), len(starts), *place, ",".join(sorted(base)), ",".join(sorted(labels)), 1 - left, tags, permissive)


RESULT = (
    ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("n_tags", pa.int64()),
    ("permissive", pa.bool_()),
)


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: base places and labels, the method's labels and score, the number of
    identifier tags and whether all their expressions leave a permissive choice (null without a tag)."""

    def rows(batch: pa.RecordBatch) -> dict:
        scan = worker_model("licences", Scanner).scan
        found = [scan(body.as_py()) for body in batch.column("body")]
        return {"doc_id": batch.column("doc_id")} | {
            name: pa.array([f[i] for f in found], kind) for i, (name, kind) in enumerate(RESULT)
        }

    return map_rows(
        id_and_bytes(docs, id_col, text_col), rows,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, n_tags long, permissive boolean",
    )
