"""Not-modified revisits resolved against earlier full responses.

A revisit record (status 304) holds no body; it stands for the latest earlier
full response of the same canonical url. That response is found by an as-of
join, the revisit's validators are checked against it, and the response's
headers are updated with those that a 304 may carry.

Records are told apart by a row id that they get when they are written, so
record ids may be of any type, repeated or null. The as-of join orders all
records by (canonical url, time, revisits first, record id, row id), deals them by ranges of that order, and carries the last response
along within each range; what enters a range from the ones before is one
response per range. So a url with a third of all records spreads over as many
tasks as any other third of the data, and no record is paired with all others
of its url.

Defined results: a revisit without an earlier response (a response at the very
same time isn't earlier) is ``orphan``; if a validator that both sides give
differs, ``mismatch``; if no validator can be compared, ``unverified``; else
``resolved``. Only resolved revisits get headers and a digest. A null url is
canonicalised to the empty string and matches nothing; a null time comes
before all times and matches nothing; repeated records are resolved one by
one, so there are as many rows as revisits; of responses of one url and time the
one with the greatest record id counts; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from mdmspark.llm.common import map_arrow, materialize

# Response headers that a not-modified answer may update.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
# Names of query parameters that don't tell pages apart.
TRACKING = r"^(utm_[a-z]+|fbclid|gclid)$"


def canonical_url(url: str = "url") -> Column:
    """Scheme and host in lower case, without the scheme's default port, the
    fragment and tracking parameters; other parameters sorted; an empty path
    is ``/``. Null, or without ``://``: empty."""
    whole = F.regexp_extract(url, r"^([^#]*)", 1)
    scheme = F.lower(F.regexp_extract(whole, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    host = F.lower(F.regexp_extract(whole, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)", 1))
    port = F.when(scheme == "http", F.regexp_replace(host, ":80$", "")).when(scheme == "https", F.regexp_replace(host, ":443$", "")).otherwise(host)
    path = F.regexp_extract(whole, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)", 1)
    query = F.split(F.regexp_extract(whole, r"^[^?]*\?(.*)$", 1), "&")
    kept = F.array_sort(F.filter(query, lambda x: (x != "") & ~F.substring_index(x, "=", 1).rlike(TRACKING)))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    full = F.concat(scheme, F.lit("://"), port, F.when(path == "", "/").otherwise(path), tail)
    return F.coalesce(F.when(scheme != "", full), F.lit(""))


def parse_headers(block: str = "headers") -> Column:
    """A header block (``Name: value`` lines) as a map with names in lower case; the last of equal names counts."""
    lines = F.filter(F.split(F.coalesce(block, F.lit("")), "\r?\n"), lambda x: x.rlike("^[^:]+:"))
    name = lambda x: F.lower(F.trim(F.substring_index(x, ":", 1)))
    pairs = F.transform(lines, lambda x: F.struct(name(x).alias("k"), F.trim(F.regexp_replace(x, "^[^:]*:", "")).alias("v")))
    last = F.filter(pairs, lambda x, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda y: y["k"] == x["k"]))
    return F.map_from_entries(last)


def latest_before(records: DataFrame, key: str, order: list[str], source: str, value: str, name: str = "as-of") -> DataFrame:
    """``records`` with ``before``: the ``value`` (of any type) of the last
    earlier record of the same ``key`` (in ``order``, which begins with it)
    whose boolean ``source`` holds; null if there is none. A written table."""
    spark = records.sparkSession
    ranged = records.repartitionByRange(*order).sortWithinPartitions(*order)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in records.schema.fields)
    kind = records.schema[value].dataType
    names, held_as = [*records.columns, "_range", "_head", "before"], to_arrow_type(kind)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, first, last, held = TaskContext.get().partitionId(), None, None, pa.scalar(None, held_as)
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            keys = b.column(key).dictionary_encode(null_encoding="encode")
            codes = keys.indices.to_numpy()
            at, end = keys.dictionary[int(codes[0])], keys.dictionary[int(codes[-1])]
            first = at if first is None else first
            goes_on = last is not None and at == last
            changes = np.flatnonzero(codes[1:] != codes[:-1]) + 1
            rows = np.arange(n)
            starts = np.zeros(n, np.int64)
            starts[changes] = changes
            starts = np.maximum.accumulate(starts)  # where the row's key begins in the batch
            is_source = b.column(source).fill_null(False).to_numpy(zero_copy_only=False)
            latest = np.maximum.accumulate(np.where(is_source, rows, -1))  # last source up to the row
            previous = np.concatenate([[-1], latest[:-1]])
            inside = previous >= starts
            values = b.column(value).cast(held_as)
            before = values.take(pa.array(np.where(inside, previous, 0), mask=~inside))
            entering = (starts == 0) & ~inside if goes_on else np.zeros(n, bool)  # what the batches before held
            if entering.any():
                before = pc.if_else(pa.array(entering), held, before)
            # Rows of the range's first key without an answer: what the ranges before held may reach them.
            of_first = starts == 0 if at == first else np.zeros(n, bool)
            heads = of_first & ~inside & ~(entering & held.is_valid)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(n, part, np.int32)), pa.array(heads), before], names=names)
            if latest[-1] >= starts[-1]:
                held = values[int(latest[-1])]
            elif not (goes_on and starts[-1] == 0):
                held = pa.scalar(None, held_as)
            last = end

    local = materialize(map_arrow(ranged, scan, f"{kinds}, _range int, _head boolean, before {kind.simpleString()}"), name)
    # The last source of each range's last key: one row per range.
    tops = local.groupBy("_range").agg(F.max(F.struct(*order)).alias("t"), F.max(F.when(F.col(source), F.struct(*order, F.col(value).alias("_v")))).alias("s"))
    carry, entering = None, []
    for r in sorted(tops.select("_range", F.col(f"t.{key}").alias("k"), F.col(f"s.{key}").alias("sk"), F.col("s._v").alias("v")).collect(), key=lambda r: r["_range"]):
        entering.append((r["_range"], *(carry or (None, None))))
        if r["sk"] == r["k"] and r["v"] is not None:
            carry = (r["k"], r["v"])
        elif carry and carry[0] != r["k"]:
            carry = None
    table = spark.createDataFrame(entering or [(0, None, None)], f"_range int, _key {records.schema[key].dataType.simpleString()}, _value {kind.simpleString()}")
    out = local.join(F.broadcast(table), "_range")
    carried = F.when(F.col("_head") & (F.col("_key") == F.col(key)), F.col("_value"))
    return out.select(*records.columns, F.coalesce("before", carried).alias("before"))


def _bare(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Every revisit of ``records`` (record_id, url, ts, status, headers,
    digest): record_id, canonical_url, ts, outcome, refers_to (the response's
    record_id), digest (its payload digest) and headers (merged, one line
    each, in order of names)."""
    base = records.select("record_id", canonical_url().alias("canonical_url"), "ts", "status", "headers", "digest")
    # Written, every record has a row id of its own, whatever its record_id.
    base = materialize(base.withColumn("row", F.monotonically_increasing_id()), "warc-records")
    known = (F.col("canonical_url") != "") & F.col("ts").isNotNull()
    order = base.select("row", "record_id", "canonical_url", "ts", F.coalesce(known & (F.col("status") == 200), F.lit(False)).alias("full"))
    found = latest_before(order, "canonical_url", ["canonical_url", "ts", "full", "record_id", "row"], "full", "row", "warc-as-of")
    revisits = base.where("status = 304").withColumnRenamed("digest", "claimed").withColumn("fields", parse_headers()).drop("headers")
    # Both lookups are written tables, so each join has nothing but an exchange on
    # either side: Spark then splits a response that very many revisits refer
    # to, or the many that refer to none.
    earlier = materialize(found.where(~F.col("full")).select("row", "before"), "warc-earlier")
    pointed = revisits.join(earlier, "row", "left")
    pointed = pointed.withColumn("before", F.when(known, F.col("before")))
    full = base.where("status = 200").select(F.col("row").alias("before"), F.col("record_id").alias("refers_to"), "headers", "digest")
    full = materialize(full, "warc-full").withColumn("stored", parse_headers()).drop("headers")
    joined = pointed.join(full, "before", "left")
    tags = _bare(F.col("fields")["etag"]), _bare(F.col("stored")["etag"])
    dates = F.col("fields")["last-modified"], F.col("stored")["last-modified"]
    sums = F.col("claimed"), F.col("digest")
    same = F.array(*[a == b for a, b in (tags, dates, sums)])
    # The strongest validator that both sides give decides.
    verdict = F.coalesce(*[same[i] for i in range(3)])
    outcome = F.when(F.col("before").isNull(), "orphan").when(verdict.isNull(), "unverified").when(verdict, "resolved").otherwise("mismatch")
    joined = joined.withColumn("outcome", outcome)
    update = F.map_filter("fields", lambda k, _: k.isin(*PERMITTED))
    merged = F.map_concat(F.map_filter("stored", lambda k, _: ~F.array_contains(F.map_keys(update), k)), update)
    lines = F.array_join(F.transform(F.array_sort(F.map_entries(merged)), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")
    done = F.col("outcome") == "resolved"
    return joined.select("record_id", "canonical_url", "ts", "outcome", "refers_to", F.when(done, F.col("digest")).alias("digest"),
                         F.when(done, lines).alias("headers"))
