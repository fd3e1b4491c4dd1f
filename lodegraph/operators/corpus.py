"""Corpus operators: inventories, quality, roll-ups, baselines and their differences, validation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Schema versions that are read, and fields that every chunk has.
SUPPORTED_SCHEMA_VERSIONS = ("1.3", "1.4", "1.5")
REQUIRED_FIELDS = ("schema_version", "pipeline_version", "analysis_timestamp", "content_hash")
#: Thresholds of chunk sizes in tokens, and the overlap of the parts of larger ones.
THIN_TOKENS, MAX_TOKENS, OVERLAP_TOKENS = 20, 512, 50
#: Chunk types that are indexed however thin they are, and those that say something by being thin.
ALWAYS_INDEXABLE = (
    "cobol_analysis_health", "analysis_health", "jcl_analysis_health", "static_values", "external_program_calls", "controlflow.cfg", "dataflow.variable", "business_rule",
    "call_contract", "error_path", "screen.pagination", "screen.selection", "screen.row_build", "screen.key_dispatch", "cics.operation", "cics.program_transfer", "cics.resource",
    "cics.error_handler", "datasets_tables_resources", "copybook_mentions", "copybook_fields", "unused_copybooks", "comments", "commented_out_code",
)
NEGATIVE_EVIDENCE = (
    "dependencies", "cobol_analysis_health", "analysis_health", "jcl_analysis_health", "external_program_calls", "datasets_tables_resources", "unused_copybooks", "comments", "commented_out_code",
)


def indexability(chunk_type: Column, tokens: Column, given: Column | None = None) -> Column:
    """struct<thin,indexable> of a chunk. given: a flag set before, which counts for chunks that are not thin."""
    kind = F.coalesce(chunk_type, F.lit(""))
    always, thin = kind.isin(*ALWAYS_INDEXABLE), tokens < THIN_TOKENS
    usual = F.lit(True) if given is None else F.coalesce(given, F.lit(True))
    return F.struct((thin & ~always).alias("thin"), F.when(always, True).when(thin, kind.isin(*NEGATIVE_EVIDENCE)).otherwise(usual).alias("indexable"))


def token_count(text: str | Column) -> Column:
    """Words between white space; 0 for null and blank text."""
    t = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.size(F.filter(F.split(t, r"\s+"), lambda x: x != "")), F.lit(0))


def content_hash(text: str | Column) -> Column:
    """First 16 hexadecimal digits of SHA-256."""
    return F.substring(F.sha2(F.col(text) if isinstance(text, str) else text, 256), 1, 16)


def duplicates(df: DataFrame, key: Column, *by: str) -> DataFrame:
    """Surplus rows per group: the sum of count - 1 over keys that come more than once."""
    per = df.withColumn("_k", key).filter("_k is not null").groupBy(*by, "_k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return per.groupBy(*by).agg(F.count(F.lit(1)).alias("n_keys"), F.sum(F.col("n") - 1).alias("n_surplus"))


def percentile(c: str, p: float) -> Column:
    """Linearly interpolated percentile, to two digits."""
    return F.round(F.percentile(c, p), 2)


def quality(chunks: DataFrame, tokens: str, *by: str) -> DataFrame:
    """Sizes per group: least, median, p90, most, thin, oversized, and rows that lack a required field."""
    lacking = reduce(lambda a, b: a | b, [F.col(f).isNull() | (F.trim(f) == "") for f in REQUIRED_FIELDS])
    return chunks.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_chunks"),
        F.min(tokens).alias("min_tokens"),
        percentile(tokens, 0.5).alias("median_tokens"),
        percentile(tokens, 0.9).alias("p90_tokens"),
        F.max(tokens).alias("max_tokens"),
        F.count_if((F.col(tokens) > 0) & (F.col(tokens) < THIN_TOKENS)).alias("n_thin"),
        F.count_if(F.col(tokens) > MAX_TOKENS).alias("n_oversized"),
        F.count_if(lacking).alias("n_lacking"),
    )


def rollup_metrics(metrics: DataFrame, *by: str) -> DataFrame:
    """Roll-up of (numerator, denominator): sums, their ratio, mean and percentiles of the percentages.

    A row without a positive denominator is not applicable: it is counted, and excluded from the rest."""
    pct = F.when(F.col("denominator") > 0, F.col("numerator") / F.col("denominator") * 100)
    m = metrics.withColumn("pct", pct)
    used = F.col("pct").isNotNull()
    return m.groupBy(*by).agg(
        F.sum(F.when(used, F.col("numerator"))).alias("numerator"),
        F.sum(F.when(used, F.col("denominator"))).alias("denominator"),
        F.try_divide(F.sum(F.when(used, F.col("numerator"))).cast("double"), F.sum(F.when(used, F.col("denominator")))).alias("ratio"),
        F.round(F.avg("pct"), 6).alias("mean_pct"),
        F.round(F.percentile("pct", 0.1), 6).alias("p10_pct"),
        F.round(F.percentile("pct", 0.5), 6).alias("p50_pct"),
        F.round(F.percentile("pct", 0.9), 6).alias("p90_pct"),
        F.count_if(~used).alias("n_na"),
    )


def coverage(expected: DataFrame, found: DataFrame, fact: str, *by: str) -> DataFrame:
    """Share of the distinct expected facts that are found, per group."""
    f = found.select(*by, fact).distinct().withColumn("_hit", F.lit(1))
    return expected.select(*by, fact).distinct().join(f, [*by, fact], "left").groupBy(*by).agg(F.count("_hit").alias("numerator"), F.count(F.lit(1)).alias("denominator"))


def weighted_mean(parts: dict[str, float]) -> Column:
    """Mean of columns with weights; null parts are left out and the weights renormalised."""
    total = reduce(lambda a, b: a + b, [F.when(F.col(c).isNotNull(), F.lit(w)).otherwise(0.0) for c, w in parts.items()])
    value = reduce(lambda a, b: a + b, [F.coalesce(F.col(c) * w, F.lit(0.0)) for c, w in parts.items()])
    return F.try_divide(value, total)


#: Weights of the parts of the confidence in an analysis, what a parse is worth, and the labels.
CONFIDENCE_WEIGHTS = {"parse": 0.30, "copybooks": 0.25, "data": 0.20, "dependencies": 0.15, "narrative": 0.10}
PARSE_WORTH = {"full": 1.0, "partial": 0.6, "degraded": 0.2}
CONFIDENCE_LABELS = [(0.85, "high"), (0.65, "medium")]


def confidence(parse_quality: Column, resolved: Column, copybooks: Column, typed: Column, fields: Column, dynamic_sql: Column, unknown_calls: Column, commented: Column, paragraphs: Column) -> Column:
    """struct<score,label,parse,copybooks,data,dependencies,narrative>: confidence in the analysis of a program.

    Parts are shares of what there is: nothing to resolve or to type counts as whole, no paragraphs as a
    half, data that were never read (null) as 0.8, as does a parse of unknown quality. Dynamic SQL costs
    0.2 of the dependencies, each of at most two calls without a known target 0.15."""
    share = lambda a, b, none: F.when(b > 0, a / b).otherwise(none)
    worth = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in PARSE_WORTH.items() for x in kv]), parse_quality), F.lit(0.8))
    parts = {
        "parse": worth,
        "copybooks": share(resolved, copybooks, 1.0),
        "data": F.when(fields.isNull(), 0.8).otherwise(share(typed, fields, 1.0)),
        "dependencies": F.greatest(F.lit(0.0), 1.0 - F.when(dynamic_sql, 0.2).otherwise(0.0) - 0.15 * F.least(unknown_calls, F.lit(2))),
        "narrative": share(commented, paragraphs, 0.5),
    }
    score = F.round(reduce(lambda a, b: a + b, [parts[k] * w for k, w in CONFIDENCE_WEIGHTS.items()]), 3)
    return F.struct(score.alias("score"), label(score, CONFIDENCE_LABELS, "low").alias("label"), *[F.round(c, 3).alias(k) for k, c in parts.items()])


def paragraph_patterns(n: dict[str, Column], others: Column) -> Column:
    """array<string> of what a paragraph does, by its counts per node type. others: nodes that are no MOVE and no paragraph."""
    branches = n["IF_BRANCH"] + n["EVALUATE"]
    say = lambda when, *parts: F.when(when, F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]))
    return F.array_compact(
        F.array(
            say(n["EXEC_SQL"] > 0, "DB2 access (", n["EXEC_SQL"], " SQL)"),
            say(n["EXEC_CICS"] > 0, "CICS operations (", n["EXEC_CICS"], " commands)"),
            say(branches > 3, "decision logic (", branches, " branches)"),
            say(n["PERFORM"] > 0, "orchestrates ", n["PERFORM"], " sub-procedures"),
            say((n["MOVE"] > 5) & (others < 5), "data initialization (", n["MOVE"], " MOVEs)"),
            say((n["READ"] > 0) | (n["WRITE"] > 0), "file I/O"),
            say((n["GOBACK"] > 0) | (n["STOP_RUN"] > 0), "terminates execution"),
        )
    )


def label(score: Column, steps: list[tuple[float, str]], otherwise: str) -> Column:
    out = None
    for bound, name in steps:
        out = F.when(score >= bound, name) if out is None else out.when(score >= bound, name)
    return out.otherwise(otherwise)


def complexity(n_edges: Column, n_nodes: Column) -> tuple[Column, Column]:
    """Edges - nodes + 2, at least 1, and its bucket."""
    c = F.greatest(n_edges - n_nodes + 2, F.lit(1))
    return c, F.when(c <= 5, "Low").when(c <= 15, "Medium").otherwise("High")


def self_evaluation(generic_pct: Column, hazards: Column, skipped: Column, degraded: Column, high: Column, medium: Column) -> Column:
    """struct<score,label>: 100 less the penalties, not below 0, as a whole number; high, medium, low or none."""
    loss = F.least(F.lit(35.0), generic_pct) + 5 * hazards + 2 * skipped + F.when(degraded, 30).otherwise(0) + 12 * high + 5 * medium
    score = F.greatest(F.lit(0.0), F.floor(F.lit(100.5) - loss)).cast("int")
    return F.struct(score.alias("score"), label(score, [(85, "high"), (65, "medium"), (35, "low")], "none").alias("label"))


def baseline_diff(a: DataFrame, b: DataFrame, key: str, metrics: list[str], tolerance: float = 0.01) -> DataFrame:
    """(key, status, changed) of two baselines: added, removed, changed, same.

    changed lists the metrics that differ by more than `tolerance`; null equals null."""
    x = a.select(key, *[F.col(m).alias(f"a_{m}") for m in metrics], F.lit(True).alias("in_a"))
    y = b.select(key, *[F.col(m).alias(f"b_{m}") for m in metrics], F.lit(True).alias("in_b"))
    differs = lambda m: ~F.col(f"a_{m}").eqNullSafe(F.col(f"b_{m}")) & F.coalesce(F.abs(F.col(f"a_{m}") - F.col(f"b_{m}")) > tolerance, F.lit(True))
    j = x.join(y, key, "full_outer")
    changed = F.array_join(F.array_compact(F.array(*[F.when(differs(m), m) for m in metrics])), ",")
    status = F.when(F.col("in_a").isNull(), "added").when(F.col("in_b").isNull(), "removed").when(changed != "", "changed").otherwise("same")
    return j.select(key, status.alias("status"), F.when(F.col("in_a") & F.col("in_b"), changed).otherwise("").alias("changed"))


def consistency(index: DataFrame, documents: DataFrame, key: str) -> DataFrame:
    """(key, problem): entries of the index without document and documents without entry."""
    i = index.select(key).distinct().withColumn("i", F.lit(True))
    d = documents.select(key).distinct().withColumn("d", F.lit(True))
    return i.join(d, key, "full_outer").filter("i is null or d is null").select(key, F.when(F.col("d").isNull(), "no_document").otherwise("no_entry").alias("problem"))


def validate(chunks: DataFrame, types: DataFrame, tokens: Column) -> DataFrame:
    """(row_id, problem) of chunk rows: lacking field, stale hash, too long, unknown type, schema version.

    One pass over the rows; the reference table of types has a fixed number of rows."""
    known = types.select(F.col("chunk_type").alias("_t"), F.lit(True).alias("_known")).distinct()
    c = chunks.withColumn("_t", F.lower(F.trim("chunk_type"))).join(F.broadcast(known), "_t", "left")
    blank = lambda f: F.col(f).isNull() | (F.trim(f) == "")
    checks = [F.when(blank(f), f"lacks {f}") for f in REQUIRED_FIELDS]
    checks.append(F.when(F.col("text").isNotNull() & F.col("content_hash").isNotNull() & (content_hash("text") != F.col("content_hash")), "stale hash"))
    checks.append(F.when(tokens > MAX_TOKENS, "too long"))
    checks.append(F.when(~blank("chunk_type") & F.col("_known").isNull(), "unknown type"))
    checks.append(F.when(~blank("schema_version") & ~F.col("schema_version").isin(*SUPPORTED_SCHEMA_VERSIONS), "unsupported version"))
    return c.select("row_id", F.explode(F.array_compact(F.array(*checks))).alias("problem"))


def first_occurrence(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of every key; null keys are equal to one another."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def islands(df: DataFrame, by: list[str], order: list[Column], inside: Column) -> DataFrame:
    """Rows within maximal runs where `inside` holds, with `run` numbered per group from 1."""
    w = Window.partitionBy(*by).orderBy(*order)
    start = F.when(inside & ~F.coalesce(F.lag(inside).over(w), F.lit(False)), 1).otherwise(0)
    return df.withColumn("_in", inside).withColumn("_s", start).withColumn("run", F.sum("_s").over(w)).filter("_in").drop("_in", "_s")


def windows(n: Column, size: int, overlap: int) -> Column:
    """array<struct<start,end>> of windows of `size` with `overlap` over n tokens; none for n = 0."""
    ov = min(overlap, size - 1)
    starts = F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(size - ov)), lambda x: (x == 0) | (x < n - ov))
    return F.when(n <= 0, F.array().cast("array<struct<start:int,end:int>>")).otherwise(F.transform(starts, lambda s: F.struct(s.cast("int").alias("start"), F.least(s + size, n).cast("int").alias("end"))))


def carry_forward(df: DataFrame, by: list[str], order: list[Column], value: Column, name: str) -> DataFrame:
    """The last value that is not null up to each row."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))


def carry_backward(df: DataFrame, by: list[str], order: list[Column], value: Column, name: str) -> DataFrame:
    """The next value that is not null from each row on."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    return df.withColumn(name, F.first(value, ignorenulls=True).over(w))


def merge_small(df: DataFrame, by: list[str], order: list[Column], size: str, least: int) -> DataFrame:
    """Groups of neighbours: a row smaller than `least` joins the group before it."""
    w = Window.partitionBy(*by).orderBy(*order)
    starts = F.when((F.col(size) >= least) | F.lag(size).over(w).isNull(), 1).otherwise(0)
    return df.withColumn("_s", starts).withColumn("group_no", F.sum("_s").over(w)).drop("_s")


def size_guard(df: DataFrame, by: str, key: str, name: str, size: str, least: int = THIN_TOKENS, most: int = MAX_TOKENS, overlap: int = OVERLAP_TOKENS) -> DataFrame:
    """(by, group_no, first_key, n_chunks, n_tokens, n_parts): chunks of a group merged and split to size.

    A chunk whose name ends with -EXIT joins the one of the name without it. Small neighbours in order of
    name join until they are large enough; what stays small joins the group before it, if there is one. A
    group beyond `most` tokens has parts that overlap. Names are read in order, with one group in memory."""
    import pyarrow as pa

    base = F.regexp_replace(name, "-EXIT$", "")
    homes = df.filter(~F.col(name).endswith("-EXIT")).groupBy(by, F.col(name).alias("_base")).agg(F.min(key).alias("_home"))
    j = df.withColumn("_base", base).join(homes, [by, "_base"], "left")
    named = j.select(by, F.when(F.col(name).endswith("-EXIT"), F.coalesce("_home", key)).otherwise(F.col(key)).alias("_key"), F.col(key).alias("_own"), F.col(name).alias("_name"), F.col(size).cast("long").alias("_size"))
    units = named.groupBy(by, "_key").agg(F.min(F.when(F.col("_own") == F.col("_key"), F.col("_name"))).alias("_name"), F.sum("_size").alias("_size"), F.count(F.lit(1)).alias("_n"))
    kinds = {f.name: f.dataType.simpleString() for f in units.schema}

    def run(batches):
        state: dict = {"by": None}

        def close() -> list[tuple]:
            """The open group; one that is too small is added to the group before it."""
            if state["open"] is None:
                return []
            first, n, total = state["open"]
            state["open"] = None
            if total < least and state["kept"] is not None:
                k = state["kept"]
                state["kept"] = (k[0], k[1], k[2] + n, k[3] + total)
                return []
            done = [] if state["kept"] is None else [(state["by"], *state["kept"])]
            state["no"] += 1
            state["kept"] = (state["no"], first, n, total)
            return done

        def finish() -> list[tuple]:
            if state["by"] is None:
                return []
            done = close()
            return done + ([] if state["kept"] is None else [(state["by"], *state["kept"])])

        def as_batch(rows: list[tuple], types: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)] if rows else [pa.array([], t) for t in types], [by, "group_no", "first_key", "n_chunks", "n_tokens"])

        types = None
        for batch in batches:
            types = [batch.schema.field(0).type, pa.int64(), batch.schema.field(1).type, pa.int64(), pa.int64()]
            out: list[tuple] = []
            for group, k, n, tokens in zip(*(batch.column(i).to_pylist() for i in (0, 1, 4, 3))):
                if state["by"] is None or group != state["by"]:
                    out += finish()
                    state = {"by": group, "open": None, "kept": None, "no": 0, "small": False}
                if state["open"] is not None and state["small"] and state["open"][2] < least and tokens < least:
                    first, m, total = state["open"]
                    state["open"] = (first, m + n, total + tokens)
                    continue
                out += close()
                state["open"], state["small"] = (k, n, tokens), tokens < least
            yield as_batch(out, types)
        if types is not None:
            yield as_batch(finish(), types)

    placed = units.repartition(F.col(by)).sortWithinPartitions(by, "_name", "_key").select(by, "_key", "_name", "_size", "_n")
    groups = placed.mapInArrow(run, f"`{by}` {kinds[by]}, group_no bigint, first_key {kinds['_key']}, n_chunks bigint, n_tokens bigint")
    parts = F.when(F.col("n_tokens") > most, F.ceil((F.col("n_tokens") - overlap) / (most - overlap))).otherwise(1).cast("int")
    return groups.withColumn("n_parts", parts)


def prefix_join(left: DataFrame, right: DataFrame, name: str, key: str) -> DataFrame:
    """Left rows with the right key they equal, else the least right key that starts with the name.

    Prefixes are joined by equality: every right key is exploded to its prefixes, and only those that are
    a left name are kept, so no pair of rows is compared that does not match."""
    r = right.select(F.upper(key).alias("k"), F.col(key).alias("right_key")).filter("k <> ''").distinct()
    pre = r.select("k", "right_key", F.explode(F.transform(F.sequence(F.lit(1), F.length("k")), lambda n: F.substring(F.col("k"), F.lit(1), n))).alias("p"))
    pre = pre.join(left.select(F.upper(name).alias("p")).distinct(), "p", "left_semi")
    best = pre.groupBy("p").agg(F.min(F.struct((F.col("k") != F.col("p")).alias("is_prefix"), "right_key")).alias("m"))
    return left.join(best, F.upper(name) == best.p, "left").select(*left.columns, F.col("m.right_key").alias("right_key"), F.when(F.col("m").isNull(), "none").when(F.col("m.is_prefix"), "prefix").otherwise("exact").alias("match"))
