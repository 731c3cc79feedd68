"""Landed SDMX-JSON messages and code lists.

A message holds the observations of one request.  Its dimensions and attributes are
indexes into lists of values, which are looked up while the message is taken apart; one
row per observation leaves the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paneltide.functions.scalars import label_of, strip
from paneltide.operators.relational import expand_codes, last_observations
from paneltide.sources import landed
from paneltide.sources import pieces as in_pieces
from paneltide.sources.observations import typed
from paneltide.spec import PanelSpec

# The parts of a message that are read.
_VALUE = "struct<id:string,name:string,names:map<string,string>>"
_DEFINITION = f"array<struct<id:string,values:array<{_VALUE}>>>"
_PARTS = f"struct<series:{_DEFINITION},observation:{_DEFINITION}>"
_SERIES = "struct<attributes:array<string>,observations:map<string,array<string>>>"
MESSAGE = (
    f"data struct<structure:struct<dimensions:{_PARTS},attributes:{_PARTS}>,"
    f"dataSets:array<struct<series:map<string,{_SERIES}>>>>"
)
# The columns of the observation table.
COLUMNS = (
    "PHARMACEUTICAL", "PHARMACEUTICAL_LABEL", "REF_AREA", "REF_AREA_LABEL", "TIME_PERIOD",
    "OBS_VALUE", "OBS_STATUS", "OBS_STATUS_LABEL", "OBS_STATUS2", "OBS_STATUS2_LABEL",
    "OBS_STATUS3", "OBS_STATUS3_LABEL", "MEASURE", "MEASURE_LABEL", "UNIT_MEASURE",
    "UNIT_MEASURE_LABEL", "MARKET_TYPE", "MARKET_TYPE_LABEL", "UNIT_MULT", "UNIT_MULT_LABEL",
)
VALUE_COLUMN = "OBS_VALUE"
CODELIST = "CL_PHARMACEUTICAL"
LAST_OBSERVATIONS = 2000
SERIES = ("PHARMACEUTICAL", "REF_AREA", "MEASURE", "UNIT_MEASURE", "MARKET_TYPE")

_ENTRIES = "array<struct<key:string,value:string>>"


def read_messages(
    spark: SparkSession, path: str, one_per_line: bool = False, files: DataFrame | None = None,
) -> DataFrame:
    """Message texts as column ``value``: one per file, or one per line (then files split).

    ``files`` are the files to read (``landed.needed_files``).
    """
    return landed.read_text(spark, path, files, wholetext=not one_per_line)


def _entry(key: Column, value: Column) -> Column:
    return F.struct(key.alias("key"), value.alias("value"))


def _coded(name: Column, meta: Column) -> Column:
    """A coded value and, if it has one, its label."""
    label = label_of(meta)
    value = _entry(name, meta["id"])
    return F.when(label.isNull(), F.array(value)).otherwise(
        F.array(value, _entry(F.concat(name, F.lit("_LABEL")), label)))


def _named(pairs: Column) -> Column:
    """Entries by name; of entries with the same name the last one counts."""
    entries = F.flatten(F.filter(pairs, lambda p: p.isNotNull()))
    names = F.transform(entries, lambda e: e["key"])
    return F.map_from_entries(F.filter(entries, lambda e, i: ~F.array_contains(
        F.slice(names, i + 2, F.greatest(F.size(names) - i - 1, F.lit(0))), e["key"])))


def _attributes(definitions: Column, cells: Column) -> Column:
    """Attribute cells by name: an index into the values of its definition, or a raw value."""
    def resolve(definition: Column, cell: Column) -> Column:
        meta = F.get(definition["values"], cell.try_cast("int"))
        raw = F.array(_entry(definition["id"], cell))
        found = F.when(meta.isNotNull(), _coded(definition["id"], meta)).otherwise(raw)
        return F.when(definition["id"].isNotNull() & cell.isNotNull(), found)

    nothing = F.array().cast(f"array<{_ENTRIES}>")
    return _named(F.coalesce(F.zip_with(definitions, cells, resolve), nothing))


def _dimensions(definitions: Column, key: Column) -> Column:
    def resolve(definition: Column, index: Column) -> Column:
        meta = F.get(definition["values"], index.try_cast("int"))
        return F.when(meta.isNotNull(), _coded(definition["id"], meta))

    return _named(F.zip_with(definitions, F.split(key, ":"), resolve))


def parse_messages(
    messages: DataFrame, columns: Sequence[str] = COLUMNS, text: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """One row per observation, all columns as text.

    ``columns`` are taken out as columns, null where a message does not have them; all
    else of an observation is in the map ``attributes``.  ``keep`` names columns of the messages to
    keep, as their ``source``.  Messages without data give no
    rows.
    """
    # A batch of series with their dimensions and attributes, then one row per observation.
    parsed = messages.select(*keep, F.from_json(F.col(text), MESSAGE)["data"].alias("_data")).select(
        *keep, F.col("_data.structure").alias("_structure"),
        F.map_entries(F.get(F.col("_data.dataSets"), F.lit(0))["series"]).alias("_all"))
    return _observations(parsed.select(*keep, *in_pieces.batches(F.col("_structure"), F.col("_all"))), columns, keep)


def parse_pieces(
    pieces: DataFrame, columns: Sequence[str] = COLUMNS, end: str = in_pieces.END, text: str = "value",
    source: str | None = None,
) -> DataFrame:
    """As ``parse_messages``, from what ``pieces.read_pieces`` reads: a long message is many tasks.

    ``source`` names a column for the file of a message.
    """
    batches = in_pieces.series_of(pieces, MESSAGE, _SERIES, end, text)
    if source is None:
        return _observations(batches, columns)
    return _observations(batches.withColumnRenamed("_file", source), columns, [source])


def _observations(batches: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per observation of batches of series with the structure of their message."""
    dimensions, attributes = F.col("_structure.dimensions"), F.col("_structure.attributes")
    time = F.get(dimensions["observation"], F.lit(0))

    def observation(entry: Column) -> Column:
        period = F.get(time["values"], entry["key"].try_cast("int"))
        cells = entry["value"]
        others = F.slice(cells, 2, F.greatest(F.size(cells) - 1, F.lit(0)))
        return F.when(period.isNotNull(), F.struct(
            _attributes(attributes["observation"], others).alias("o"),
            period["id"].alias("time"), F.get(cells, F.lit(0)).alias("number")))

    def series(entry: Column) -> Column:
        found = F.transform(F.map_entries(entry["value"]["observations"]), observation)
        return F.struct(
            _dimensions(dimensions["series"], entry["key"]).alias("d"),
            _attributes(attributes["series"], entry["value"]["attributes"]).alias("s"),
            time["id"].alias("time_name"),
            F.filter(found, lambda o: o.isNotNull()).alias("observations"))

    fits = F.filter("_entries", lambda e: F.size(F.split(e["key"], ":")) == F.size(dimensions["series"]))
    rows = batches.select(*keep, F.explode(F.transform(fits, series)).alias("_s")).select(
        *keep, "_s.d", "_s.s", "_s.time_name", F.explode("_s.observations").alias("_o")).select(
        *keep, "d", "s", "time_name", "_o.*")

    def column(name: str) -> Column:
        if name == VALUE_COLUMN:
            return F.coalesce(F.col("o")[name], F.col("number"))
        found = F.coalesce(F.col("o")[name], F.when(F.col("time_name") == name, F.col("time")),
                           F.col("s")[name], F.col("d")[name])
        return found

    known = F.array(*[F.lit(c) for c in columns])
    rest = F.map_concat(
        F.map_filter("d", lambda k, v: ~F.map_contains_key("o", k) & ~F.map_contains_key("s", k)),
        F.map_filter("s", lambda k, v: ~F.map_contains_key("o", k)), F.col("o"))
    return rows.select(
        *keep, *[column(c).alias(c) for c in columns],
        F.map_filter(rest, lambda k, v: ~F.array_contains(known, k)).alias("attributes"))


def parse_codelist(
    messages: DataFrame, codelist: str = CODELIST, text: str = "value"
) -> DataFrame:
    """Distinct ids of one code list, without blanks around or blank ids."""
    def items(value: str, *paths: str) -> Column:
        found = [F.expr(f"try_variant_get({value}, '$.{p}', 'array<variant>')") for p in paths]
        return F.coalesce(*[F.when(F.size(f) > 0, f) for f in found])

    parsed = messages.select(F.expr(f"try_parse_json(`{text}`)").alias("m"))
    lists = parsed.select(F.explode(items(
        "m", "data.codelists", "data.Codelists", "codelists", "Codelists")).alias("c"))
    wanted = lists.where(F.expr("try_variant_get(c, '$.id', 'string')") == codelist)
    codes = wanted.select(F.explode(items("c", "codes", "items", "Items")).alias("i"))
    ids = F.expr("coalesce(nullif(try_variant_get(i, '$.id', 'string'), ''), "
                 "try_variant_get(i, '$.Id', 'string'))")
    return codes.select(strip(ids).alias("id")).where(F.length("id") > 0).distinct()


def load_observations(
    messages: DataFrame, spec: PanelSpec, columns: Sequence[str] = COLUMNS,
    codes: Sequence[str] | None = None, codelist: DataFrame | None = None,
    code: str = "PHARMACEUTICAL", series: Sequence[str] = SERIES,
    last_n: int | None = LAST_OBSERVATIONS, folder: str | None = None, end: str | None = None,
) -> DataFrame:
    """Typed observations of all messages, for the requested codes.

    One-letter codes stand for all codes of the list that start so.  ``last_n`` keeps
    the newest observations of every series.  ``folder`` names the column of the messages
    that has their code, if they lie in folders by code: the others are not read then.
    With ``end`` the messages are pieces that end so, from ``pieces.read_pieces``.
    """
    if codes is not None and folder is not None:
        letters = [c for c in codes if len(c) == 1]
        messages = messages.where(
            F.col(folder).isin(*codes) | F.substring(folder, 1, 1).isin(*letters) if letters
            else F.col(folder).isin(*codes))
    parsed = parse_messages(messages, columns) if end is None else parse_pieces(messages, columns, end)
    rows = typed(parsed, spec)
    if codes is not None:
        if any(len(c) == 1 for c in codes):
            if codelist is None:
                raise ValueError("one-letter codes need the code list")
            wanted = expand_codes(codelist, codes).select(F.col("id").alias(code)).distinct()
            rows = rows.join(wanted, code, "left_semi")
        else:
            rows = rows.where(F.col(code).isin(*codes))
    if last_n is not None:
        rows = last_observations(rows, list(series), spec.time, last_n)
    return rows
