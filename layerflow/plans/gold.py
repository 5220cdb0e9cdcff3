"""Gold views declared in a SQL file.

A file may hold statements ``CREATE OR REFRESH MATERIALIZED VIEW name AS ( select );`` in any letter case; other
statements are passed over. A small scanner cuts the text into words, quoted texts, comments, parentheses and
semicolons, so that these can stand inside a body. Each body runs through ``spark.sql``; every Spark SQL
operator is available in it.

Names may have one to three parts. The session catalog knows two at most, so a table's name of three parts loses its first
part (the catalog), and a name of a view built earlier is read from that view, whichever way it is spelled. Which words of a
body are names of tables is what Spark's own parser says of it; those bound by a ``WITH`` are left alone. Views are built
in file order.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..storage import replace_folder

_PIECE = re.compile(
    r"""(?P<comment>--[^\n]*|/\*(?:.|\n)*?\*/)|(?P<text>'(?:\\.|''|[^'\\])*'|"(?:\\.|""|[^"\\])*")"""
    r"""|(?P<name>(?:`(?:``|[^`])*`|\w+)(?:\s*\.\s*(?:`(?:``|[^`])*`|[A-Za-z_]\w*))*)|(?P<mark>[();])|(?P<other>\s+|.)""",
    re.DOTALL,
)
_NAME = re.compile(r"(?:`(?:``|[^`])*`|\w+)(?:\s*\.\s*(?:`(?:``|[^`])*`|\w+))*")
_HEADER = ("create", "or", "refresh", "materialized", "view")


@dataclass(frozen=True)
class Piece:
    kind: str
    text: str

    @property
    def word(self) -> str:
        return self.text.lower() if self.kind == "name" else self.text


def pieces(sql_text: str) -> list[Piece]:
    return [Piece(m.lastgroup, m.group()) for m in _PIECE.finditer(sql_text)]


def statements(sql_text: str) -> Iterator[list[Piece]]:
    """The pieces of each statement; a semicolon between parentheses ends none."""
    own: list[Piece] = []
    depth = 0
    for p in pieces(sql_text):
        if p.kind == "mark":
            depth = max(0, depth + {"(": 1, ")": -1, ";": 0}[p.text])
            if p.text == ";" and not depth:
                yield own
                own = []
                continue
        own.append(p)
    yield own


def name_parts(name: str) -> tuple[str, ...]:
    """The parts of a name, without quotes."""
    found = re.findall(r"`((?:``|[^`])*)`|(\w+)", name)
    return tuple(quoted.replace("``", "`") or plain for quoted, plain in found)


def _solid(own: list[Piece]) -> list[Piece]:
    return [p for p in own if p.kind != "comment" and p.text.strip()]


def view_statements(sql_text: str) -> list[tuple[str, str]]:
    """(name, body) of every materialized-view statement, in file order."""
    found = []
    for own in statements(sql_text):
        solid = _solid(own)
        words = tuple(p.word for p in solid[:len(_HEADER)])
        if words != _HEADER or len(solid) < len(_HEADER) + 4:
            continue
        name, keyword, opening = solid[len(_HEADER):len(_HEADER) + 3]
        if name.kind != "name" or keyword.word != "as" or opening.text != "(" or solid[-1].text != ")":
            continue
        start, end = own.index(opening), len(own) - 1 - own[::-1].index(solid[-1])
        found.append((name.text, "".join(p.text for p in own[start + 1:end]).strip()))
    return found


def _tail_matches(known: tuple[str, ...], asked: tuple[str, ...]) -> bool:
    n = min(len(known), len(asked))
    return [x.lower() for x in known[-n:]] == [x.lower() for x in asked[-n:]]


def _seq(spark: SparkSession, found) -> list:
    return list(spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(found))


def table_places(spark: SparkSession, body: str) -> list[tuple[int, tuple[str, ...]]]:
    """(place in the text, parts) of every table that a SELECT reads, from the unresolved plan of the session's parser.
    Names that a ``WITH`` in reach binds are no tables."""
    jvm = spark._jvm
    relation, with_plan, subquery = (
        jvm.java.lang.Class.forName(f"org.apache.spark.sql.catalyst.{name}")
        for name in ("analysis.UnresolvedRelation", "plans.logical.UnresolvedWith", "expressions.SubqueryExpression"))
    found: list[tuple[int, tuple[str, ...]]] = []

    def of_expression(e, bound: frozenset[str]) -> None:
        if subquery.isInstance(e):
            of_plan(e.plan(), bound)
        for child in _seq(spark, e.children()):
            of_expression(child, bound)

    def of_plan(plan, bound: frozenset[str]) -> None:
        if relation.isInstance(plan):
            parts, start = tuple(_seq(spark, plan.multipartIdentifier())), plan.origin().startIndex()
            if start.isDefined() and not (len(parts) == 1 and parts[0].lower() in bound):
                found.append((start.get(), parts))
            return
        if with_plan.isInstance(plan):
            for cte in _seq(spark, plan.cteRelations()):  # each may read those before it
                own = cte.productElement(0).lower()
                of_plan(cte.productElement(1), bound | {own} if plan.allowRecursion() else bound)
                bound = bound | {own}
        for e in _seq(spark, plan.expressions()):
            of_expression(e, bound)
        for child in _seq(spark, plan.children()):
            of_plan(child, bound)

    of_plan(spark._jsparkSession.sessionState().sqlParser().parsePlan(body), frozenset())
    return sorted(found)


def on_session_names(spark: SparkSession, body: str, built: dict[tuple[str, ...], str]) -> str:
    """The body with its tables under names that the session knows: views built earlier (``built``: parts → temporary
    view) and two-part names of the catalog."""
    out, at = [], 0
    for start, parts in table_places(spark, body):
        written = _NAME.match(body, start)
        if written is None or start < at:
            continue
        low = [x.lower() for x in parts]
        exact = [v for known, v in built.items() if [x.lower() for x in known] == low]
        alike = exact or [v for known, v in built.items() if _tail_matches(known, parts)]
        if len(alike) == 1:
            text = f"`{alike[0]}`"
        elif len(parts) == 3:
            text = ".".join(f"`{x}`" for x in parts[1:])
        else:
            continue
        out += [body[at:start], text]
        at = written.end()
    return "".join([*out, body[at:]])


def short_name(name: str) -> str:
    return name_parts(name)[-1]


def table_name(name: str) -> str:
    """Two-part name of a view's stored table: its last two parts, or ``gold`` and its only part."""
    parts = name_parts(name)
    return ".".join(parts[-2:]) if len(parts) > 1 else f"gold.{parts[0]}"


def _session_view(name: str) -> str:
    """A temporary view of its own for every full name."""
    parts = name_parts(name)
    return f"{parts[-1]}__{hashlib.md5('.'.join(parts).lower().encode()).hexdigest()[:8]}"


def _publish(df: DataFrame, name: str, all_names: list[str]) -> str:
    """Register a view under its own session name, and under its last part if no other view ends in it."""
    view = _session_view(name)
    df.createOrReplaceTempView(view)
    if sum(short_name(n).lower() == short_name(name).lower() for n in all_names) == 1:
        df.createOrReplaceTempView(short_name(name))
    return view


def build_views(spark: SparkSession, sql_text: str) -> dict[str, DataFrame]:
    """Plan every view of ``sql_text``; nothing runs until a view is read or saved.

    Parse and analysis errors surface here, before anything is written.
    """
    found = view_statements(sql_text)
    views: dict[str, DataFrame] = {}
    built: dict[tuple[str, ...], str] = {}
    for name, body in found:
        views[name] = spark.sql(on_session_names(spark, body, built))
        built[name_parts(name)] = _publish(views[name], name, [n for n, _ in found])
    return views


def materialize_views(spark: SparkSession, sql_text: str, location: str) -> dict[str, str]:
    """Build every view and replace its parquet folder below ``location`` (one for each full name).

    Returns view name → folder. The new rows are written beside the old folder and then take its place, so a failed
    job leaves the old table. Later views read the stored rows.
    """
    found = view_statements(sql_text)
    written: dict[str, str] = {}
    built: dict[tuple[str, ...], str] = {}
    for name, body in found:
        path = "/".join([location.rstrip("/"), *name_parts(name)])
        replace_folder(spark, spark.sql(on_session_names(spark, body, built)), path)
        built[name_parts(name)] = _publish(spark.read.parquet(path), name, [n for n, _ in found])
        written[name] = path
    return written


def read_sql_file(spark: SparkSession, path: str, most_bytes: int = 16 << 20) -> str:
    """The text of a SQL file on any Spark-readable storage. A file of statements is small: more than
    ``most_bytes`` below ``path`` is refused before anything is read."""
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    size = files.agg({"length": "sum"}).first()[0] or 0
    if size > most_bytes:
        raise ValueError(f"{path}: {size} bytes are no SQL file")
    rows = spark.read.option("wholetext", "true").text(path).collect()
    return "\n".join(r.value for r in rows)
