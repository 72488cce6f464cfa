"""Column profiles: one wide aggregate plus one count of (column, value) pairs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.functions.hashing import LONG_TEXT, compact, hex_to_long
from tablewarden.functions.text import SEMANTIC_PATTERNS, semantic_label
from tablewarden.operators.dedup import top_per_key

TOP_N = 5  # fixed value
COLUMN = ["column_name"]
MIN_SHARE_TENTHS = 6  # fixed value: six tenths of the values decide a semantic type
TIE_BITS = 40  # ten hexadecimal digits of a value's digest, below its count in one bigint


def _carrier(kind: T.DataType) -> str:
    """The type a column's values are counted as; whole numbers and doubles stay numbers until counted."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "bigint"
    return "double" if isinstance(kind, T.DoubleType) else "string"


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, value, n) for all columns; copies of a value are summed before the shuffle.

    Columns of one kind are counted together and become text afterwards. A long text is represented
    by its start and digest, so documents are not shuffled; its semantic label is taken from the
    text itself. Columns travel by number, not by name.
    """
    carriers = {c: _carrier(df.schema[c].dataType) for c in columns}
    names = F.array(*[F.lit(c) for c in columns])
    parts = []
    for carrier in ("bigint", "double", "string"):
        members = [c for c in columns if carriers[c] == carrier]
        if not members:
            continue
        keys = ["column_number", "value"] + (["long_label"] if carrier == "string" else [])
        cells = []
        for column in members:
            value = f"CAST(`{column}` AS {carrier})"
            shown, label = value, ""
            if carrier == "string":
                shown = compact(value)
                label = f"CASE WHEN length({value}) > {LONG_TEXT} THEN coalesce({semantic_label(value)}, 'text') END"
                label = f", 'long_label', {label}"
            cells.append(f"named_struct('column_number', {columns.index(column)}, 'value', {shown}{label})")
        counted = df.select(F.expr(f"inline(array({', '.join(cells)}))")).groupBy(*keys).agg(F.count("*").alias("n"))
        long_label = F.col("long_label") if carrier == "string" else F.lit(None).cast("string")
        parts.append(
            counted.select(
                F.get(names, F.col("column_number")).alias("column_name"),
                F.col("value").cast("string").alias("value"),
                long_label.alias("long_label"),
                "n",
            )
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _percent(part: Column, whole: Column) -> Column:
    ratio = part.cast("decimal(20,0)") * 100 / F.nullif(whole, F.lit(0)).cast("decimal(20,0)")
    return F.coalesce(F.round(ratio, 2), F.lit(0)).cast("double")


def column_stats(counts: DataFrame, by: list[str] = COLUMN) -> DataFrame:
    """Rows, NULLs, distinct values and inferred type per column, from the value counts.

    Every distinct value votes with its number of rows; the first pattern that fits is its vote.
    """
    label = F.expr(f"CASE WHEN value IS NOT NULL THEN coalesce(long_label, {semantic_label('value')}) END")
    stats = (
        counts.withColumn("label", label)
        .groupBy(*by)
        .agg(
            F.sum("n").alias("row_count"),
            F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("null_count"),
            F.count("value").alias("distinct_count"),
            *[F.expr(f"sum(CASE WHEN label = '{t}' THEN n ELSE 0 END)").alias(t) for t in SEMANTIC_PATTERNS],
        )
    )
    voters = F.col("row_count") - F.col("null_count")
    winner = F.lit("text")
    for semantic in reversed(list(SEMANTIC_PATTERNS)):
        winner = F.when(F.col(semantic) * 10 >= voters * MIN_SHARE_TENTHS, semantic).otherwise(winner)
    return stats.select(
        *by,
        "row_count",
        "null_count",
        _percent(F.col("null_count"), F.col("row_count")).alias("null_pct"),
        "distinct_count",
        _percent(F.col("distinct_count"), F.col("row_count")).alias("distinct_pct"),
        F.when(voters == 0, F.lit("unknown")).otherwise(winner).alias("inferred_type"),
    )


def long_texts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, value, full_text) of the texts that value counts hold as digests."""
    texts = [c for c in columns if df.schema[c].dataType.typeName() in ("string", "array", "struct", "binary")]
    cells = [f"named_struct('column_name', '{c}', 'full_text', CAST(`{c}` AS string))" for c in texts]
    if not cells:
        return df.sparkSession.createDataFrame([], "column_name string, full_text string, value string")
    return (
        df.select(F.expr(f"inline(array({', '.join(cells)}))"))
        .where(F.length("full_text") > LONG_TEXT)
        .withColumn("value", F.expr(compact("full_text")))
    )


def _place(n: Column, tie: Column) -> Column:
    """Count and start of the tie as one bigint, never smaller for a value that ranks before another.

    Counts that leave no room for the tie all share the largest number.
    """
    start = F.lit((1 << TIE_BITS) - 1) - hex_to_long(tie, digits=TIE_BITS // 4)
    return F.when(n >= 1 << (63 - TIE_BITS), F.lit((1 << 63) - 1)).otherwise(n * F.lit(1 << TIE_BITS) + start)


def _contenders(counts: DataFrame, tie: Column, n: int, by: list[str]) -> DataFrame:
    """Counts without most of the values that cannot be among the first ``n`` of their column; no first one is lost.

    Values are dealt to buckets by hash. The n-th of the buckets' best places bounds the column: n values are at or above
    it, so one below it has n values before it. Best places are a hash aggregate of fixed size, so the values
    themselves are not sorted. NULLs, and columns with fewer buckets, have no bound and pass.
    """
    bucket = F.pmod(F.xxhash64("value"), F.lit(16 * max(n, 1))).alias("_bucket")
    place = F.when(F.col("value").isNotNull(), _place(F.col("n"), tie))
    best = counts.groupBy(*by, bucket).agg(F.max(place).alias("_place"))
    bounds = (
        top_per_key(best.where("_place IS NOT NULL"), by, [F.desc("_place")], n)
        .groupBy(*by)
        .agg(F.min("_place").alias("_bound"), F.count("*").alias("_places"))
        .where(F.col("_places") == n)
        .select(*by, "_bound")
    )
    # the count is looked at first: most values fail by it and their digests are not taken again
    reaches = (F.col("n") >= F.shiftright("_bound", TIE_BITS)) & (place >= F.col("_bound"))
    # a left join and coalesce, so that no filter reaches the counts and changes their exchange; a row per column at most
    joined = counts.join(F.broadcast(bounds), by, "left")
    return joined.where(F.coalesce(reaches, F.lit(True))).drop("_bound")


def top_values(counts: DataFrame, texts: DataFrame, n: int = TOP_N, by: list[str] = COLUMN) -> DataFrame:
    """The most frequent values per column as ``v:c|v:c``; ties of any length in the order of their SHA-256.

    Only values that reach a bound on the first ``n`` places are sorted. Digests of long texts that made it to the top are swapped back for their texts, which takes a second look at the
    text columns for at most ``n`` values each; so few are broadcast, and the texts stay where they are.
    """
    # NULLs rank last and go afterwards, so that the counts are the same exchange the statistics read
    tie = F.when(F.col("long_label").isNotNull(), F.right("value", F.lit(64))).otherwise(F.sha2("value", 256))
    contenders = _contenders(counts, tie, n, by).withColumn("_tie", tie)
    order = [F.col("value").isNull().asc(), F.desc("n"), F.asc("_tie")]
    best = top_per_key(contenders, by, order, n).where(F.col("value").isNotNull())
    wanted = F.broadcast(best.where("long_label IS NOT NULL").select(*by, "value"))  # n rows per column at most
    found = texts.join(wanted, [*by, "value"], "left_semi").distinct()
    best = best.join(found, [*by, "value"], "left")
    entry = F.struct((-F.col("n")).alias("rank"), "_tie", "n", F.coalesce("full_text", "value").alias("shown"))
    listed = F.transform(
        F.array_sort(F.collect_list(entry)), lambda e: F.concat(e["shown"], F.lit(":"), e["n"].cast("string"))
    )  # at most n entries per column
    return best.groupBy(*by).agg(F.array_join(listed, "|").alias("top_values"))


def is_number(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def value_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Range of every column; mean and deviation of numbers, lengths of everything else.

    Numbers and the rest are read separately, each with its own columns: an aggregate over
    numbers alone stays in generated code.
    """
    numbers = [c for c in columns if is_number(df.schema[c].dataType)]
    others = [c for c in columns if c not in numbers]
    if numbers and others:
        return _value_stats(df, numbers, True).unionByName(_value_stats(df, others, False))
    return _value_stats(df, columns, bool(numbers))


def _value_stats(df: DataFrame, columns: list[str], number: bool) -> DataFrame:
    sums, rows = [], []
    for i, c in enumerate(columns):
        column, kind = f"`{c}`", df.schema[c].dataType.simpleString()
        found = {"min_value": f"min({column})", "max_value": f"max({column})"}
        if number:
            found["mean_value"] = f"avg(CAST({column} AS double))"
            found["stddev_value"] = f"stddev_samp(CAST({column} AS double))"
        else:
            found["min_length"] = f"min(length(CAST({column} AS string)))"
            found["max_length"] = f"max(length(CAST({column} AS string)))"
        sums += [F.expr(aggregate).alias(f"{name}{i}") for name, aggregate in found.items()]
        kinds = {"min_value": "string", "max_value": "string", "mean_value": "double", "stddev_value": "double",
                 "min_length": "int", "max_length": "int"}
        fields = [f"'column_name', '{c}', 'data_type', '{kind}'"]
        for name, target in kinds.items():
            fields.append(f"'{name}', CAST({f'{name}{i}' if name in found else 'NULL'} AS {target})")
        rows.append(f"named_struct({', '.join(fields)})")
    return df.agg(*sums).select(F.expr(f"inline(array({', '.join(rows)}))"))


def columns_of(df: DataFrame) -> list[str]:
    """Columns that can be profiled; maps cannot be compared."""
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]


def profile(
    df: DataFrame, table: str, *, schema: str = "main", columns: list[str] | None = None, top_n: int = TOP_N
) -> DataFrame:
    """Full profile, one row per column. Exact; nothing is sampled."""
    return profile_tables({table: df.select(*columns) if columns else df}, schema=schema, top_n=top_n)


def profile_tables(tables: Mapping[str, DataFrame], *, schema: str = "main", top_n: int = TOP_N) -> DataFrame:
    """Profiles of all columns of several tables; statistics and top values are taken for all at once."""
    counts, texts, values = [], [], []
    for name, df in tables.items():
        columns, label = columns_of(df), F.lit(name)
        counts.append(value_counts(df, columns).withColumn("table_name", label))
        texts.append(long_texts(df, columns).withColumn("table_name", label))
        values.append(value_stats(df, columns).withColumn("table_name", label))
    by = ["table_name", "column_name"]
    counted = _stack(counts)
    parts = (
        _stack(values)
        .join(column_stats(counted, by), by, "left")
        .join(top_values(counted, _stack(texts), top_n, by), by, "left")
    )
    return parts.select(
        F.lit(schema).alias("schema_name"),
        "table_name",
        "column_name",
        "data_type",
        F.coalesce("inferred_type", F.lit("unknown")).alias("inferred_type"),
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
        F.coalesce("null_count", F.lit(0)).alias("null_count"),
        F.coalesce("null_pct", F.lit(0.0)).alias("null_pct"),
        F.coalesce("distinct_count", F.lit(0)).alias("distinct_count"),
        F.coalesce("distinct_pct", F.lit(0.0)).alias("distinct_pct"),
        "min_value",
        "max_value",
        "mean_value",
        "stddev_value",
        "min_length",
        "max_length",
        F.coalesce("top_values", F.lit("")).alias("top_values"),
    )


def type_profiles(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The short profile: counts and inferred types only, from one count of the values."""
    counts = [value_counts(df, columns_of(df)).withColumn("table_name", F.lit(n)) for n, df in tables.items()]
    return column_stats(_stack(counts), ["table_name", "column_name"])


def _stack(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def drift(before: DataFrame, after: DataFrame) -> DataFrame:
    """Change of NULL share, distinct share and inferred type between two profiles."""
    wanted = ["null_pct", "distinct_pct", "inferred_type"]
    old = before.select("table_name", "column_name", *[F.col(c).alias(f"old_{c}") for c in wanted])
    new = after.select("table_name", "column_name", *[F.col(c).alias(f"new_{c}") for c in wanted])
    return old.join(new, ["table_name", "column_name"], "full_outer").select(
        "table_name",
        "column_name",
        F.round(F.col("new_null_pct") - F.col("old_null_pct"), 2).alias("null_pct_change"),
        F.round(F.col("new_distinct_pct") - F.col("old_distinct_pct"), 2).alias("distinct_pct_change"),
        "old_inferred_type",
        "new_inferred_type",
        (~F.col("old_inferred_type").eqNullSafe(F.col("new_inferred_type"))).alias("type_changed"),
    )


def suggest_rules(profiles: DataFrame) -> DataFrame:
    """Rules a profile speaks for: format of e-mails, no NULLs, unique values."""
    wide = profiles.where("row_count > 0")
    suggestion = F.array_compact(
        F.array(
            F.when(F.col("inferred_type") == "email", F.struct(F.lit("validity").alias("dimension"), F.lit("email format").alias("rule"))),
            F.when(F.col("null_count") == 0, F.struct(F.lit("completeness").alias("dimension"), F.lit("not null").alias("rule"))),
            F.when(F.col("distinct_count") == F.col("row_count"), F.struct(F.lit("uniqueness").alias("dimension"), F.lit("unique").alias("rule"))),
        )
    )
    return wide.select("table_name", "column_name", F.explode(suggestion).alias("s")).select(
        "table_name", "column_name", "s.dimension", "s.rule"
    )


def candidate_keys(profiles: DataFrame) -> DataFrame:
    """Columns without NULLs whose values are all different."""
    return profiles.where("row_count > 0 AND null_count = 0 AND distinct_count = row_count").select(
        "table_name", "column_name", "row_count"
    )


def semantic_rule(profiles: DataFrame, declared: Mapping[str, str]) -> DataFrame:
    """PASS where a column's inferred type is the declared one."""
    wanted = F.create_map(*[F.lit(x) for pair in declared.items() for x in pair])
    checked = profiles.where(F.col("column_name").isin(list(declared)))
    return checked.select(
        "table_name",
        "column_name",
        wanted[F.col("column_name")].alias("declared_type"),
        "inferred_type",
        F.when(wanted[F.col("column_name")] == F.col("inferred_type"), "PASS").otherwise("FAIL").alias("status"),
    )
