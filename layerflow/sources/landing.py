"""Landing preparation as DataFrame work.

The HTTP client is not part of the library (see README); what remains is data
work on tables of requests and responses: derive resource keys, fan requests
out over parent rows, pull the payload list out of a response body, and land
payloads as JSON-array files that bronze ingest reads back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructField, StructType

# Landed timestamps keep their microseconds (Spark's default writes milliseconds).
JSON_WRITE_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

# The placeholders an endpoint template may contain.
PARENT_PLACEHOLDER = "{idWeatherstation}"
YEAR_PLACEHOLDER = "{year}"


def resource_key(endpoint: Column) -> Column:
    """L1: last path part of the endpoint; if that is a placeholder (contains
    ``{``), the first path part instead (``/stations/{id}/sensors`` → sensors,
    ``/readings/.../{year}`` → readings)."""
    parts = F.split(endpoint, "/")
    last = F.element_at(parts, -1)
    return F.when(last.contains("{"), F.get(parts, 1)).otherwise(last)


def previous_month_param(run_date: Column) -> Column:
    """L4: ``{year}`` value for the month before ``run_date``: ``Y?month=M``
    (January wraps to December of the year before)."""
    prev = F.add_months(run_date, -1)
    return F.concat(F.year(prev).cast("string"), F.lit("?month="), F.month(prev).cast("string"))


def fan_out_requests(
    parents: DataFrame,
    parent_key: str,
    endpoint_template: str,
    base_url: str = "",
    run_date: Column | None = None,
    placeholder: str = PARENT_PLACEHOLDER,
) -> DataFrame:
    """L3: one request per parent row, the parent id substituted for the template's ``placeholder``.

    Output: ``parent_key``, ``resource_key``, ``endpoint``, ``url``.
    """
    endpoint = F.replace(F.lit(endpoint_template), F.lit(placeholder), F.col(parent_key).cast("string"))
    if YEAR_PLACEHOLDER in endpoint_template:
        when = run_date if run_date is not None else F.current_date()
        endpoint = F.replace(endpoint, F.lit(YEAR_PLACEHOLDER), previous_month_param(when))
    return parents.select(
        F.col(parent_key),
        resource_key(F.lit(endpoint_template)).alias("resource_key"),
        endpoint.alias("endpoint"),
        F.concat(F.lit(base_url), endpoint).alias("url"),
    )


def extract_payload(responses: DataFrame, body: str, list_key: str, element_type: DataType, keep: list[str] = ()) -> DataFrame:
    """L2: rows of the list stored under ``list_key`` of each JSON body; a body
    without the key contributes no row."""
    arr = F.from_json(F.get_json_object(F.col(body), f"$.{list_key}"), ArrayType(element_type, True))
    return responses.select(*keep, F.inline(arr))


def dependent_requests(
    responses: DataFrame, body: str, dependency_key: str, parent_key: str, parent_type: DataType, endpoint_template: str, **request,
) -> DataFrame:
    """L3 by the control row's dependency: the parents are the list under the dependency's ``key`` in the responses
    of its endpoint; ``parent_key`` is the field of a parent that the template asks for."""
    parents = extract_payload(responses, body, dependency_key, StructType([StructField(parent_key, parent_type)]))
    return fan_out_requests(parents, parent_key, endpoint_template, **request)


def first_element_children(responses: DataFrame, array_col: str, child_field: str, keep: list[str] = ()) -> DataFrame:
    """The children of the first element of every response, one row each;
    appending across responses is the union the rows already form."""
    first = F.get(F.col(array_col), 0)
    return responses.select(*keep, F.explode(first.getField(child_field)).alias("child")).select(*keep, "child.*")


def land_json_arrays(
    df: DataFrame,
    base_path: str,
    key: str,
    landed_at: Column,
    poison: Column | None = None,
    mode: str = "append",
    group: Column | None = None,
) -> None:
    """Write records as JSON-array lines under ``{base}/key={key}/landed_at=…/``.

    Each line is one array of the records with one ``landed_at`` and ``group`` (as
    one API answer holds them; the caller's group bounds its length), or of one
    record. ``poison`` (a boolean column) appends a ``null`` element to an array, as
    an empty API answer does. The landing folder name carries the timestamp that
    ``file_date`` reads; rows are gathered by it, and a folder of many rows is dealt over
    several tasks and files again by its size.
    """
    record = F.to_json(F.struct(*[F.col(c) for c in df.columns]), JSON_WRITE_OPTIONS)
    rows = df.select(
        landed_at.alias("landed_at"), record.alias("record"), (poison if poison is not None else F.lit(False)).alias("poison"),
        (group if group is not None else F.lit(None)).cast("string").alias("group"))
    if group is None:
        lines = rows.select("landed_at", F.array("record").alias("records"), "poison")
    else:
        lines = rows.groupBy("landed_at", "group").agg(
            F.sort_array(F.collect_list("record")).alias("records"), F.bool_or("poison").alias("poison"))
    value = F.concat(F.lit("["), F.array_join("records", ","), F.when(F.col("poison"), ", null").otherwise(""), F.lit("]"))
    (
        lines.select(F.lit(key).alias("key"), "landed_at", value.alias("value")).hint("rebalance", F.col("landed_at"))
        .write.mode(mode).partitionBy("key", "landed_at").text(base_path)
    )
