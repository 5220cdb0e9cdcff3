"""Token counts of whole texts with a public tokenizer file (``.json``).

A huge text is encoded chunk by chunk and resynchronised: a chunk is encoded with an overlap into
the next one, the overlap is encoded once more from the cold start of the next chunk, and the two are
spliced at a common token border that is proven stable. Such a border lies at ASCII white space: the
file's normaliser and pre-tokenizer drop white space, so no token and no special string spans it and
what stands on one side cannot change the other. Where the overlap has no such border, it is widened
(doubled) until it has one or the text ends. The result is that of the text encoded at once.

A text of one chunk falls apart at the same borders; the count of each run between them is asked from
the library once and remembered in the Python worker, up to a bound.

Results for special input: null and empty texts have 0 tokens (and 0 bytes); invalid UTF-8 is read with
replacement characters; repeated rows give repeated results; an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

import os

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_and_bytes, map_rows, worker_model

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 512
MEMO_ENTRIES = 500_000
MEMO_BYTES = 64
#: ASCII punctuation that may close a run; no part of a special string.
CLOSING = b".,!?;:%$&*#"
#: What separates runs; the same characters as for ``bytes.split()``.
BORDERS = frozenset(" \t\n\x0b\x0c\r")


class TokenCounter:
    """Counts of one tokenizer file, without begin, end, truncation or padding."""

    def __init__(self, path: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        if self._count("ab cd") != self._count("ab") + self._count("cd") or self._count(" \n") or any(
            BORDERS & set(t.content) or t.lstrip or t.rstrip for t in self.tokenizer.get_added_tokens_decoder().values()
        ):
            raise ValueError(f"{path}: only tokenizers that drop white space are supported")
        self.parts_closing = self._parts_closing()
        self.chunk, self.overlap = chunk, overlap
        self.memo: dict[bytes, int] = {}
        self.widened = 0

    def _count(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False))

    def _parts_closing(self) -> bool:
        """Whether case does not count and closing punctuation is always a part of its own, as the file's own steps say."""
        normal, parts = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        if normal is None or parts is None:
            return False
        alike = all(normal.normalize_str(x) == normal.normalize_str(x.lower()) for x in ("AbZ", "\u00c7\u00c9", "\u0416x9", "\u0130"))
        marks = [chr(c) for c in CLOSING]
        return alike and all(
            parts.pre_tokenize_str(normal.normalize_str(word + mark))[0][1][1] == len(word) for word in ("ab", "x9", "\u00e9") for mark in marks)

    def count(self, body: bytes) -> int:
        """Tokens of a text given as UTF-8."""
        if len(body) > self.chunk:
            text = body.decode("utf-8", "replace")
            if len(text) > self.chunk:
                return self.count_huge(text)
        memo, total, asked = self.memo, 0, []
        for run in body.split():
            try:
                total += memo[run]
            except KeyError:
                asked.append(run)
        return total + self.ask(asked) if asked else total

    def ask(self, runs: list[bytes]) -> int:
        """Counts of runs that are not remembered. A run of lower-cased word and closing punctuation is asked as these
        two if the tokenizer always parts them and case does not count (``parts_closing``)."""
        memo, parts, asked = self.memo, [], {}
        for run in runs:
            if self.parts_closing and len(run) <= MEMO_BYTES and b"<" not in run and (stem := run.lower().rstrip(CLOSING))[-1:].isalnum():
                own = (stem, run[len(stem):])
            else:
                own = (run,)  # may hold a special string, which is found before case is dropped
            parts.append(own)
            for part in own:
                if part and part not in memo:
                    asked[part] = 0
        found = self.tokenizer.encode_batch_fast([p.decode("utf-8", "replace") for p in asked], add_special_tokens=False)
        for part, encoding in zip(asked, found):
            asked[part] = len(encoding)
        if len(memo) + len(asked) + len(runs) > MEMO_ENTRIES:
            kept = {part: memo[part] for own in parts for part in own if part in memo}
            memo.clear()
            memo.update(kept)
        total = 0
        for run, own in zip(runs, parts):
            n = sum(asked[part] if part in asked else memo[part] for part in own if part)
            total += n
            if len(run) <= MEMO_BYTES:
                memo[run] = n
        memo.update((part, n) for part, n in asked.items() if len(part) <= MEMO_BYTES)
        return total

    def count_huge(self, text: str) -> int:
        """Tokens of a text of several chunks: spliced where both encodings of an overlap agree."""
        total, at, n = 0, 0, len(text)
        while n - at > self.chunk + self.overlap:
            cold = at + self.chunk
            overlap = self.overlap
            while True:
                end = min(n, cold + overlap)
                ends = [e for _, e in self._spans(text, at, end)]
                if end == n:
                    return total + len(ends)
                border = self._common_border(text, cold, end, set(ends))
                if border is not None:
                    break
                overlap *= 2
                self.widened += 1
            total += sum(e <= border for e in ends)
            at = border
        return total + self._count(text[at:])

    def _spans(self, text: str, start: int, end: int) -> list[tuple[int, int]]:
        """(begin, end) of the tokens of text[start:end], as places of the whole text."""
        found = self.tokenizer.encode(text[start:end], add_special_tokens=False)
        return [(a + start, b + start) for a, b in found.offsets]

    def _common_border(self, text: str, cold: int, end: int, ends: set[int]) -> int | None:
        """The last place in the overlap at which a token ends in both encodings and white space follows; None if there
        is none. White space is dropped and no token reaches over it (both checked in the constructor), so from such a
        place on a text is encoded alike, whatever stands before."""
        for place in sorted({e for _, e in self._spans(text, cold, end)} & ends, reverse=True):
            if cold < place < end and text[place] in BORDERS:
                return place
        return None


def counter(path: str) -> TokenCounter:
    """The worker's counter for a file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
    return worker_model(f"tokens {path}", lambda: TokenCounter(path))


def token_counts(docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens) of every whole text."""

    def rows(batch: pa.RecordBatch) -> dict:
        count = counter(path).count
        n_bytes, n_tokens = [], []
        for body in batch.column("body"):
            body = body.as_py()
            n_bytes.append(len(body))
            n_tokens.append(count(body))
        return {
            "doc_id": batch.column("doc_id"), "n_bytes": pa.array(n_bytes, pa.int64()),
            "n_tokens": pa.array(n_tokens, pa.int64()), "over_limit": pa.array([n > limit for n in n_tokens], pa.bool_()),
        }

    return map_rows(
        id_and_bytes(docs, id_col, text_col), rows, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )
