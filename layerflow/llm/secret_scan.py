"""Secret scans of whole texts: fixed patterns, and literals that reach names of secrets.

Base spans are the matches of three patterns (``assign``, ``access``, ``hex``). On top, texts that name a secret
anywhere are lexed as source or configuration: names, string literals, bare values and operators, comments and prose
being only more of the same. Assignments (``name = value``, ``"name": value``, ``name: type = value``, ``name := value``,
``name => value``, ``obj["name"] = value``, ``<name>value</name>``) give pairs of a target name and a value: a literal,
another name, ``$NAME`` or ``${NAME}``, or several of these joined by ``+`` or ``.``. A name's literals are kept from
there on, so a literal that was given to a harmless name counts when that name is handed on to a sensitive one. Every
literal is scored by the most sensitive name that it reaches (words of the name, lowered by words such as ``file`` or
``count``) times how much it looks like a secret (length, kinds of characters, spread; placeholders and references do
not). Literals of ``LEAST_SCORE`` or more add a span of kind ``literal`` without its quotes.

Spans are in code points, the end exclusive. Results for special input: null and empty texts have no spans; invalid
UTF-8 is read with replacement characters; letters outside ASCII never match by case; an unclosed quote ends with its
line; a name assigned twice holds its last value; equal spans of one kind appear once; repeated rows give repeated
results; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_bytes, map_rows

# The base patterns, in order, with the least length of a match (assign: of its second group).
BASE = (
    ("assign", re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
)
KINDS = (*(b[0] for b in BASE), "literal")

#: What a word of a name adds to its sensitivity.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "passcode": 0.9, "pwd": 0.9, "pass": 0.7, "secret": 0.9, "secrets": 0.8,
    "token": 0.9, "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "privatekey": 1.0, "accesskey": 1.0, "secretkey": 1.0,
    "authorization": 0.8, "bearer": 0.8, "cookie": 0.6, "signature": 0.5, "auth": 0.6, "dsn": 0.6,
}
#: ``key`` is sensitive behind these words only.
KEY_BEFORE = frozenset("api access private secret signing encryption account auth master shared client session ssh".split())
#: Words that make a name speak of a secret rather than hold it.
ABOUT = frozenset(
    "file path dir url uri name id count length len size min max type policy field label hint regex pattern prompt header reset"
    " expires expiry ttl timeout limit enabled required valid is has public format version index column page form".split())
PLACEHOLDER = re.compile(
    r"(?ai)^(?:change_?me.*|your.*|my.*(?:password|secret|token|key)|example.*|sample.*|placeholder.*|dummy.*|test(?:ing)?|todo.*|none|null"
    r"|nil|true|false|undefined|redacted|password|passwd|secret|token|string|str|int|bool|required|optional|x+|\*+|\.+|-+|_+|<.*>|\{\{.*\}\}|%.*%"
    r"|\$\{?[\w.]+\}?|\(.*\)|(.)\1*)$")
LEAST_SCORE = 0.5

_HINT = re.compile(r"(?ai)pass|pwd|secret|token|key|cred|auth|bearer|cookie|signature|dsn")
_TAG = re.compile(r"<([A-Za-z_][\w.\-]*)>([^<>\r\n]+)</\1>")
_LEX = re.compile(
    r"""(?P<text>"(?:\\.|[^"\\\r\n])*"|(?<![\w'])'(?:\\.|[^'\\\r\n])*'|`(?:\\.|[^`\\\r\n])*`)"""
    r"""|(?P<ref>\$\{?[A-Za-z_]\w*\}?)"""
    r"""|(?P<op>:=|=>|==|!=|<=|>=|\+=|[=:+,;()\[\]{}<>|&])|(?P<line>\r\n|\r|\n)|(?P<bare>[^\s"'`,;()\[\]{}<>=:+|&]+|['"`])""")
_NAME = re.compile(r"(?a)^-{0,2}[A-Za-z_$@][\w$]*(?:[.\-][A-Za-z_$@][\w$]*)*$")
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_ASSIGN = frozenset(("=", ":", ":=", "=>", "+="))
#: Words before a name that are no part of it.
_DECLARES = frozenset("const let var val final static public private export set string str char def auto my our local".split())


# ---------------------------------------------------------------- base spans

def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, by start, then kind; matches do not overlap within a kind, and those
    that fail the length are dropped."""
    found = []
    for place, (kind, pattern, group, least) in enumerate(BASE):
        if kind == "access" and "AKIA" not in text:
            continue
        if kind == "hex":  # a match is a whole run, so only the long runs need to be found
            found += [(m.start(), place, m.end()) for m in _LONG_HEX.finditer(text)]
        else:
            found += [(m.start(), place, m.end()) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    return [(KINDS[place], start, end) for start, place, end in sorted(found)]


_LONG_HEX = re.compile(r"[0-9a-f]{%d,}" % BASE[2][3])


# ---------------------------------------------------------------- names and literals

def sensitivity(name: str) -> float:
    """0 to 1: how surely a variable, field or option of this name holds a secret."""
    words = [w.lower() for w in _WORDS.findall(name.rsplit(".", 1)[-1])]
    best = 0.0
    for i, w in enumerate(words):
        best = max(best, SENSITIVE.get(w, 0.0))
        if w in ("key", "keys") and i and words[i - 1] in KEY_BEFORE:
            best = max(best, 0.9)
    if "csrf" in words:
        best *= 0.5
    return best * 0.4 if ABOUT.intersection(words) - {"id"} or words[-1:] == ["id"] else best


def plausibility(value: str, quoted: bool) -> float:
    """0 to 1: how much a literal looks like a secret and not like a placeholder, a word or a sentence."""
    n = len(value)
    if n < 4 or PLACEHOLDER.match(value) or value.startswith(("http://", "https://", "/", "./", "~")) and "@" not in value:
        return 0.0
    if any(c.isspace() for c in value) and value.count(" ") > 2:
        return 0.1
    kinds = sum(bool(re.search(k, value)) for k in (r"[a-z]", r"[A-Z]", r"[0-9]", r"[^A-Za-z0-9\s]"))
    counts = Counter(value)
    spread = -sum(c / n * math.log2(c / n) for c in counts.values())
    score = 0.25 + 0.15 * kinds + 0.1 * min(spread, 4.0) / 2 + (0.15 if n >= 8 else 0.0) + (0.15 if n >= 16 and spread > 3 else 0.0)
    if not quoted and kinds < 2:
        score *= 0.4  # an ordinary word of prose or code
    return min(score, 1.0)


# ---------------------------------------------------------------- pairs

class _Token:
    __slots__ = ("kind", "text", "start", "end")

    def __init__(self, kind: str, text: str, start: int, end: int):
        self.kind, self.text, self.start, self.end = kind, text, start, end


Literal = tuple[int, int, str, bool]


def lex(text: str) -> list[_Token]:
    return [_Token(m.lastgroup, m.group(), m.start(), m.end()) for m in _LEX.finditer(text)]


def _inside(t: _Token) -> Literal:
    return (t.start + 1, t.end - 1, t.text[1:-1], True)


def _target(tokens: list[_Token], i: int) -> str | None:
    """The name that ends just before token ``i``: a bare name, a quoted key, or a quoted subscript."""
    t = tokens[i - 1] if i else None
    if t is not None and t.text == "]" and i >= 3 and tokens[i - 2].kind == "text":
        return tokens[i - 2].text[1:-1]
    if t is None:
        return None
    if t.kind == "text":
        return t.text[1:-1] if _NAME.match(t.text[1:-1]) else None
    if t.kind == "bare" and _NAME.match(t.text) and t.text not in _DECLARES:
        return t.text.lstrip("-")
    return t.text.strip("${}") if t.kind == "ref" else None


class Assignment:
    """One value of one name: the literals that stand in it, and the earlier assignments that it refers to."""

    __slots__ = ("name", "literals", "refers")

    def __init__(self, name: str, literals: list[Literal], refers: list[int]):
        self.name, self.literals, self.refers = name, literals, refers


def _value(tokens: list[_Token], i: int, known: dict[str, int]) -> tuple[list[Literal], list[int], int]:
    """Literals and references of the value from token ``i`` on, and the place behind it. A call, a block or an
    unknown reference holds nothing."""
    literals: list[Literal] = []
    refers: list[int] = []
    while i < len(tokens):
        t = tokens[i]
        after = tokens[i + 1].text if i + 1 < len(tokens) else ""
        if t.kind == "text":
            names = [a or b for a, b in _INSIDE.findall(t.text)]
            through = [known[n] for n in names if n in known]
            refers += through
            if not through:
                literals.append(_inside(t))
        elif t.kind == "ref":
            refers += [known[n] for n in [t.text.strip("${}")] if n in known]
        elif t.kind == "bare" and after not in ("(", "["):
            if t.text in known:
                refers.append(known[t.text])
            elif t.text.lower() in _PREFIXES and i + 1 < len(tokens):
                i += 1
                continue
            else:
                literals.append((t.start, t.end, t.text, False))
        else:
            break
        i += 1
        if i + 1 < len(tokens) and tokens[i].text in ("+", ".", "||", "|") and tokens[i + 1].kind != "line":
            i += 1
            continue
        break
    return literals, refers, i


_INSIDE = re.compile(r"\$\{?([A-Za-z_]\w*)\}?|\{([A-Za-z_]\w*)\}")
#: Marks before a string, and words before a value.
_PREFIXES = frozenset(("new", "await", "f", "b", "r", "u", "rb", "br", "@", "-"))


def assignments(text: str) -> list[Assignment]:
    """The assignments of a text in order; a reference is the place of an earlier one in the list."""
    tokens = lex(text)
    known: dict[str, int] = {}
    found: list[Assignment] = []
    i = 0
    while i < len(tokens):
        t = tokens[i]
        name = _target(tokens, i) if t.kind == "op" and t.text in _ASSIGN else None
        if name is None:
            i += 1
            continue
        at = i + 1
        if t.text == ":":  # name: type = value
            j = at
            while j < len(tokens) and j < at + 8 and (tokens[j].kind == "bare" or tokens[j].text in "[]<>|,"):
                j += 1
            if at < j < len(tokens) and tokens[j].text == "=":
                at = j + 1
        literals, refers, behind = _value(tokens, at, known)
        if t.text == "+=" and name in known:
            refers.append(known[name])
        if literals or refers:
            known[name] = known[name.rsplit(".", 1)[-1]] = len(found)
            found.append(Assignment(name, literals, refers))
        i = behind if i < behind < len(tokens) and tokens[behind].text not in _ASSIGN else i + 1
    found += [Assignment(m[1], [(m.start(2), m.end(2), m[2], True)], []) for m in _TAG.finditer(text)]
    return found


def literal_spans(text: str, least: float = LEAST_SCORE) -> list[tuple[int, int, str, float]]:
    """(start, end, name, score) of the literals that reach a name of a secret, by place. Names are handed back from
    the last assignment to the first, so that each is looked at once, however long a chain of references is."""
    if not _HINT.search(text):
        return []
    found = assignments(text)
    reached = [(sensitivity(a.name), a.name) for a in found]
    best: dict[tuple[int, int], tuple[float, str]] = {}
    for i in range(len(found) - 1, -1, -1):
        weight, name = reached[i]
        if weight < least:
            continue
        for j in found[i].refers:
            reached[j] = max(reached[j], reached[i])
        for start, end, value, quoted in found[i].literals:
            score = round(weight * plausibility(value, quoted), 6)
            if score >= least:
                best[start, end] = max(best.get((start, end), (0.0, "")), (score, name))
    return [(start, end, name, score) for (start, end), (score, name) in sorted(best.items())]


# ---------------------------------------------------------------- the operator

def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans): array of (kind, start, end, name, score) by start, then kind; name and score of literals only."""

    def rows(batch: pa.RecordBatch) -> dict:
        out = []
        for body in batch.column("body"):
            text = body.as_py().decode("utf-8", "replace")
            spans = [(s, KINDS.index(k), e, None, None) for k, s, e in base_spans(text)]
            spans += [(s, len(BASE), e, name, score) for s, e, name, score in literal_spans(text)]
            out.append([{"kind": KINDS[k], "start": s, "end": e, "name": name, "score": score}
                        for s, k, e, name, score in sorted(spans, key=lambda x: x[:3])])
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("name", pa.string()), ("score", pa.float64())]))
        return {"doc_id": batch.column("doc_id"), "spans": pa.array(out, kind)}

    return map_rows(
        id_and_bytes(docs, id_col, text_col), rows,
        "doc_id long, spans array<struct<kind string, start long, end long, name string, score double>>")


def secret_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_literal, most_sensitive."""
    found = secret_spans(docs, id_col, text_col)
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"] != KINDS[-1])
    return found.select(
        "doc_id", of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"),
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
        of("literal").alias("n_literal"), F.array_max(F.transform("spans", lambda s: s["score"])).alias("most_sensitive"))
