"""SentencePiece encoding and decoding of merge-type (BPE) models.

A segmentation of a string is its merge encoding exactly when every token, and
every two neighbouring tokens, re-merge to themselves: no merge then ever crosses
a token border, so the merges inside the tokens run as they would alone. There is
only one such segmentation. It is found by backtracking: an Aho-Corasick automaton
over the vocabulary gives the longest token from each place reached, one match after the
other; each is checked against its left neighbour by re-merging the two (remembered for
each pair), its longest prefix among the tokens is tried next, and a bitfield marks the
character positions from which no compatible continuation exists, so each is left only
once.

Before that, a text is cut where no token of the vocabulary can span the cut
(derived from the vocabulary: before a space mark, around characters that occur
in no longer token, between a Latin letter and punctuation that never follows a
letter inside a token). Cuts change nothing in the result, and the encodings of
the short pieces between them are remembered per Python worker, in two generations of
bounded size: what the younger does not hold is taken over from the older one.

Results for special input: null and empty texts encode to the begin and end ids
alone and decode to the empty text; characters outside the vocabulary become byte
tokens; invalid UTF-8 is read with replacement characters; repeated rows give
repeated results; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import string
from array import array
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_and_bytes, map_rows, worker_model

SPACE = "▁"
#: Letters after which punctuation may be cut off, as a class of a regular expression.
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
#: Entries of a generation of the memories of words and pieces (about 200 bytes each); of pairs (100 bytes) four times as many.
MEMO_ENTRIES = 100_000
MEMO_CHARS = 48
#: Longest matches known at a time, and how many are looked up ahead.
MATCHES, AHEAD = 8192, 64
_NONE, _UNKNOWN = -2, -1


class Memory:
    """A dictionary of two generations: when the younger is full it becomes the older, and what that held is forgotten
    unless it was asked for in the meantime."""

    __slots__ = ("entries", "young", "old")

    def __init__(self, entries: int):
        self.entries, self.young, self.old = entries, {}, {}

    def get(self, key):
        """The value, or None."""
        found = self.young.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.young) >= self.entries:
            self.old, self.young = self.young, {}
        self.young[key] = value


class PieceCodec:
    """Encoder and decoder for one model file. The library only reads the vocabulary."""

    def __init__(self, model_path: str, memo_entries: int = MEMO_ENTRIES):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=model_path)
        if sp.normalize(" ﬁ  á") != f"{SPACE}{SPACE}ﬁ{SPACE}{SPACE}á":
            raise ValueError(f"{model_path}: only models that keep the text as it is, behind a space mark, are supported")
        self.bos, self.eos, self.unk = sp.bos_id(), sp.eos_id(), sp.unk_id()
        self.ids: dict[str, int] = {}
        self.rank: dict[str, float] = {}
        self.byte_ids: dict[int, int] = {}
        self.out: list[bytes] = []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_control(i):
                self.out.append(b"")
            elif sp.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.out.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_unknown(i):
                self.out.append(" ⁇ ".encode())
            else:
                self.ids[piece] = i
                self.rank[piece] = -sp.get_score(i)
                self.out.append(piece.replace(SPACE, " ").encode())
        if {c for piece in self.ids for c in piece} - set(self.ids):
            raise ValueError(f"{model_path}: a character of a longer token is no token itself")
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        self.size = len(self.out)
        self.same = list(range(self.size))  # one object for each id, for all that the memories hold
        self.piece_of = {i: piece for piece, i in self.ids.items()}
        self.chars = {i: len(piece) for piece, i in self.ids.items()}
        self.shorter = {  # the longest beginning of a token that is a token itself
            i: next((self.ids[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in self.ids), _NONE) for p, i in self.ids.items()}
        self.shorter[_UNKNOWN] = _NONE
        self.by_run, self.pieces = self._cutter()
        self.memo = Memory(memo_entries)  # pieces that do not begin with a space mark
        self.words = Memory(memo_entries)  # what stands between two spaces, and pieces behind a space mark
        self.pairs = Memory(4 * memo_entries)  # left id * size + right id; size as left: the start of a piece

    def _cutter(self) -> tuple[bool, re.Pattern]:
        """Whether a text can be cut before its space marks, and what finds the pieces between all cuts."""
        pairs = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        inside = {c for pair in pairs for c in pair}
        if any(b[1] == SPACE != b[0] for b in pairs):
            return False, re.compile(r"(?s).+")
        letter = re.compile(f"[{LETTERS}]")
        after = {b[1] for b in pairs if letter.match(b[0])}
        alone = "".join(re.escape(c) for c in "\n\t\r" if c not in inside)
        alone_class = f"[{alone}]|" if alone else ""
        ends = "".join(re.escape(c) for c in string.punctuation if c not in after)
        return True, re.compile(
            f"{SPACE}*[{LETTERS}]+(?=[{SPACE}{alone}{ends}]|\\Z)|{alone_class}{SPACE}*[^{SPACE}{alone}]+|{SPACE}+"
        )

    # ------------------------------------------------------------ encoding

    def remerge(self, s: str) -> list[str]:
        """Merge encoding by its definition: the best-ranked pair first, the leftmost among equals."""
        parts, rank, none = list(s), self.rank, float("inf")
        ranks = [rank.get(a + b, none) for a, b in zip(parts, parts[1:])]
        while ranks and (best := min(ranks)) != none:
            i = ranks.index(best)
            parts[i] += parts.pop(i + 1)
            ranks.pop(i)
            if i:
                ranks[i - 1] = rank.get(parts[i - 1] + parts[i], none)
            if i < len(ranks):
                ranks[i] = rank.get(parts[i] + parts[i + 1], none)
        return parts

    def fits(self, key: int) -> bool:
        """Whether two neighbours re-merge to themselves."""
        known = self.pairs.get(key)
        if known is None:
            left, right = divmod(key, self.size)
            parts = [self.piece_of[i] for i in (left, right) if i < self.size]
            known = self.remerge("".join(parts)) == parts
            self.pairs.put(key, known)
        return known

    def longest(self, s: str, at: int, known: dict[int, int]) -> int:
        """The longest token from ``at`` on, and in ``known`` those of the places that follow it."""
        if len(known) > MATCHES:
            known.clear()
        for end, i in islice(self.automaton.iter_long(s, at), AHEAD):
            start = end - self.chars[i] + 1
            if start in known:
                break
            known[start] = i
        return known.setdefault(at, _UNKNOWN)

    def tokens(self, s: str) -> list[int]:
        """Backtracking search for the only segmentation whose neighbours all fit; -1 for a character
        outside the vocabulary, beside which no merge can happen."""
        n, size, chars, shorter = len(s), self.size, self.chars, self.shorter
        known: dict[int, int] = {}
        failed = bytearray((n >> 3) + 1)
        tokens: list[int] = []
        at, left = 0, size
        own = self.longest(s, 0, known) if n else _NONE
        while at < n:
            while own != _NONE:
                end = at + (chars[own] if own >= 0 else 1)
                if not failed[end >> 3] >> (end & 7) & 1:
                    if own < 0:
                        break
                    fit = self.pairs.young.get(key := left * size + own)
                    if self.fits(key) if fit is None else fit:
                        break
                own = shorter[own]
            if own != _NONE:
                tokens.append(own)
                at = end
                left = own if own >= 0 else size  # behind a character outside the vocabulary: as at the start
                if at < n:
                    own = known.get(at)
                    if own is None:
                        own = self.longest(s, at, known)
            elif tokens:
                failed[at >> 3] |= 1 << (at & 7)
                own = tokens.pop()
                at -= chars[own] if own >= 0 else 1
                own = shorter[own]
                left = tokens[-1] if tokens and tokens[-1] >= 0 else size
            else:
                raise ValueError("no compatible segmentation: not a merge-type vocabulary")
        return tokens

    def piece_ids(self, s: str) -> tuple[int, ...]:
        found, same = self.tokens(s), self.same
        if -1 not in found:
            return tuple([same[i] for i in found])
        out: list[int] = []
        at = 0
        for i in found:
            if i >= 0:
                out.append(same[i])
                at += self.chars[i]
            else:
                out.extend([self.byte_ids[b] for b in s[at].encode()] if self.byte_ids else [self.unk])
                at += 1
        return tuple(out)

    def run_ids(self, run: str) -> tuple[int, ...]:
        """Ids of a run that starts with a space mark: those of its pieces, one after the other."""
        out: list[int] = []
        for piece in self.pieces.findall(run):
            # A piece behind one space mark is a word of its own, and remembered as such.
            of, key = (self.words, piece[1:]) if piece[0] == SPACE and self.by_run else (self.memo, piece)
            own = of.get(key)
            if own is None:
                own = self.piece_ids(piece)
                if len(piece) <= MEMO_CHARS:
                    of.put(key, own)
            out += own
        return tuple(out)

    def encode(self, text: str) -> list[int]:
        """All ids of a text, begin and end included."""
        ids = [self.bos]
        runs = text.split(" ")
        if "" in runs or not self.by_run or SPACE in text:
            if text:
                ids += self.run_ids(SPACE + text.replace(" ", SPACE))
        else:
            words = self.words
            for word in runs:
                own = words.young.get(word)
                if own is None:
                    own = words.get(word)
                    if own is None:
                        own = self.run_ids(SPACE + word)
                        if len(word) <= MEMO_CHARS:
                            words.put(word, own)
                ids += own
        ids.append(self.eos)
        return ids

    # ------------------------------------------------------------ decoding

    def decode(self, ids: list[int]) -> bytes:
        """UTF-8 of the decoded text; begin and end ids give nothing, the first space mark goes."""
        body = b"".join(map(self.out.__getitem__, ids))
        body = body[1:] if body[:1] == b" " else body
        return body.decode("utf-8", "replace").encode()


def codec(model_path: str) -> PieceCodec:
    """The worker's codec for a model."""
    return worker_model(f"pieces {model_path}", lambda: PieceCodec(model_path))


def little_endian(ids: list[int]) -> bytes:
    out = array("I", ids)
    if array("I", [1]).tobytes()[0] != 1:
        out.byteswap()
    return out.tobytes()


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the ids of every whole text."""

    def rows(batch: pa.RecordBatch) -> dict:
        enc = codec(model_path).encode
        ids = [enc(b.decode("utf-8", "replace")) for b in batch.column("body").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "ids": pa.array(ids, pa.list_(pa.int32()))}

    return map_rows(id_and_bytes(docs, id_col, text_col), rows, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids)."""

    def rows(batch: pa.RecordBatch) -> dict:
        dec = codec(model_path).decode
        text = [dec(ids or []).decode() for ids in batch.column("ids").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "text": pa.array(text, pa.string())}

    return map_rows(encoded.select("doc_id", "ids"), rows, "doc_id long, text string")


def codec_digest(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encoded and decoded in one pass, ids never leave the task."""

    def rows(batch: pa.RecordBatch) -> dict:
        own = codec(model_path)
        counts, ids_sha, decoded_sha = [], [], []
        for body in batch.column("body"):
            ids = own.encode(body.as_py().decode("utf-8", "replace"))
            counts.append(len(ids))
            ids_sha.append(hashlib.sha256(little_endian(ids)).hexdigest())
            decoded_sha.append(hashlib.sha256(own.decode(ids)).hexdigest())
        return {
            "doc_id": batch.column("doc_id"), "n_tokens": pa.array(counts, pa.int64()),
            "ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(decoded_sha, pa.string()),
        }

    return map_rows(
        id_and_bytes(docs, id_col, text_col), rows,
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
