"""Derived facts: level-number trees, searches in trees, call and copy resolution, generated documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Programs of the operating system, which no corpus holds.
SYSTEM_UTILITIES = ("IEFBR14", "ICEMAN", "IDCAMS", "IEBGENER", "SORT", "PARM2SK")
#: Highest level number of a record's fields; 66, 77 and 88 have rules of their own.
DEEPEST_LEVEL = 49


def level_tree(entries: DataFrame, by: str, order: Column, level: str, key: str) -> DataFrame:
    """Entries with `parent`: the last entry before it with a smaller level number.

    Level 77 and 01 are roots, 66 is detached, 88 is a condition of the entry before it that is no
    condition. Levels out of these have no parent. One sort per `by` serves all levels."""
    w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    at = F.struct(F.row_number().over(Window.partitionBy(by).orderBy(order)).alias("n"), F.col(key).alias("id"))
    d = entries.withColumn("_at", at)
    last = lambda cond: F.last(F.when(cond, F.col("_at")), ignorenulls=True).over(w)
    lv = F.col(level)
    smaller = F.array_max(F.array_compact(F.array(*[F.when(lv > k, last(lv == k)) for k in range(1, DEEPEST_LEVEL)])))
    parent = F.when(lv.between(2, DEEPEST_LEVEL), smaller["id"]).when(lv == 88, last((lv != 88) & (lv != 66))["id"])
    return d.withColumn("parent", parent).drop("_at")


def find_first(rows: DataFrame, by: str, order: Column, where: Column, key: str) -> DataFrame:
    """(by, key) of the first row in order that meets the predicate."""
    return rows.filter(where).groupBy(by).agg(F.min_by(key, order).alias(key))


def find_narrowest(closure: DataFrame, rows: DataFrame, where: Column) -> DataFrame:
    """(root, id, depth): the deepest row of each tree that meets the predicate with all its ancestors.

    Ties by least id. closure: (id, ancestor, n) with n = 0 for the row itself."""
    ok = rows.select(F.col("id").alias("ancestor"), F.coalesce(where, F.lit(False)).alias("ok"))
    chain = closure.join(ok, "ancestor").groupBy("id").agg(F.bool_and("ok").alias("ok"), F.max_by("ancestor", "n").alias("root"), F.max("n").alias("depth")).filter("ok")
    return chain.groupBy("root").agg(F.min(F.struct(-F.col("depth"), "id")).alias("m")).select("root", F.col("m.id").alias("id"), (-F.col("m.col1")).alias("depth"))


def find_where(closure: DataFrame, rows: DataFrame, criterion: Column, direct: Column | None = None, below: Column | None = None) -> DataFrame:
    """Rows that meet the criterion, have a child that meets `direct` and a descendant that meets `below`."""
    out = rows.filter(criterion)
    for cond, depth in ((direct, F.col("n") == 1), (below, F.col("n") > 0)):
        if cond is not None:
            hit = closure.filter(depth).join(rows.filter(cond).select("id"), "id", "left_semi").select(F.col("ancestor").alias("id")).distinct()
            out = out.join(hit, "id", "left_semi")
    return out


#: Letters that a name has at least to be looked for within file names.
LEAST_CONTAINED = 3


def resolve_names(wanted: DataFrame, files: DataFrame, name: str, file: str, permissive: bool = True) -> DataFrame:
    """(name, file, how): file of a program or copybook name; exact, case, extension, contains, or null.

    Candidates are joined by equality: on the name, on its upper case, on the file's stem, and last on the
    parts of a stem, which are as many as the square of a file name's length. The first file by name wins."""
    f = files.select(F.col(file).alias("f")).filter("f is not null").distinct()
    stem = F.regexp_replace(F.upper("f"), r"\.[A-Z0-9]+$", "")
    keys = F.array(F.struct(F.col("f").alias("k"), F.lit(0).alias("rank"), F.lit("exact").alias("how")))
    if permissive:
        starts = F.sequence(F.lit(1), F.greatest(F.length(stem) - LEAST_CONTAINED + 1, F.lit(1)))
        parts = F.flatten(F.transform(starts, lambda i: F.transform(F.sequence(F.lit(LEAST_CONTAINED), F.greatest(F.length(stem) - i + 1, F.lit(LEAST_CONTAINED))), lambda n: F.substring(stem, i, n))))
        contained = F.transform(F.array_distinct(parts), lambda k: F.struct(k.alias("k"), F.lit(3).alias("rank"), F.lit("contains").alias("how")))
        keys = F.concat(keys, F.array(F.struct(F.upper("f").alias("k"), F.lit(1).alias("rank"), F.lit("case").alias("how")), F.struct(stem.alias("k"), F.lit(2).alias("rank"), F.lit("extension").alias("how"))), contained)
    options = f.select("f", F.inline(keys)).groupBy("k").agg(F.min(F.struct("rank", "f", "how")).alias("m"))
    w = wanted.select(name).distinct()
    tried = w.select(name, F.explode(F.array_distinct(F.array(F.col(name), F.upper(name)))).alias("k")).join(options, "k").groupBy(name).agg(F.min("m").alias("m"))
    return w.join(tried, name, "left").select(name, F.col("m.f").alias(file), F.col("m.how").alias("how"))


def step_programs(steps: DataFrame, programs: DataFrame) -> DataFrame:
    """Steps with is_utility and in_corpus of the program they run."""
    p = programs.select(F.upper("program").alias("program")).distinct().withColumn("_in", F.lit(True))
    s = steps.withColumn("program", F.upper("program")).join(p, "program", "left")
    return s.withColumns({"is_utility": F.coalesce(F.col("program").isin(*SYSTEM_UTILITIES), F.lit(False)), "in_corpus": F.coalesce("_in", F.lit(False))}).drop("_in")


def merge_provenance(sources: list[DataFrame], keys: list[str]) -> DataFrame:
    """Rows of several sources, one per key: that of the first source which has it; all sources listed."""
    every = None
    for i, s in enumerate(sources):
        r = s.withColumn("_rank", F.lit(i))
        every = r if every is None else every.unionByName(r, allowMissingColumns=True)
    rest = [c for c in every.columns if c not in (*keys, "_rank")]
    g = every.groupBy(*keys).agg(F.min_by(F.struct(*rest), "_rank").alias("m"), F.array_sort(F.collect_set("_rank")).alias("sources"))
    return g.select(*keys, "m.*", F.array_join(F.col("sources").cast("array<string>"), ",").alias("sources"))


def expand_procedures(steps: DataFrame, procedures: DataFrame) -> DataFrame:
    """Steps that call a procedure replaced by its steps, with the call's overrides over the defaults.

    steps: job, n, proc, symbols map. procedures: proc, m, program, defaults map."""
    j = steps.join(procedures, "proc", "left")
    merged = F.map_from_entries(F.concat(F.filter(F.map_entries("defaults"), lambda e: ~F.map_contains_key(F.col("symbols"), e["key"])), F.map_entries("symbols")))
    return j.select("job", "n", "proc", "m", "program", F.when(F.col("defaults").isNotNull(), merged).otherwise(F.col("symbols")).alias("symbols"))


def pack_lines(c: Column, title: str, limit: int) -> Column:
    """array<string>: lines packed into parts of at most `limit` words, each after the first with the
    title again; a line of more words is a part of its own."""
    words = lambda x: F.size(F.filter(F.split(x, r"\s+"), lambda t: t != ""))

    def step(s: Column, line: Column) -> Column:
        n = words(line)
        full = (s["n"] > 0) & (s["n"] + n > limit)
        return F.struct(
            F.when(full, F.concat(s["done"], F.array(s["now"]))).otherwise(s["done"]).alias("done"),
            F.when(full, F.concat(F.lit(f"{title} (continued):\n"), line)).when(s["n"] == 0, line).otherwise(F.concat(s["now"], F.lit("\n"), line)).alias("now"),
            F.when(full, n).otherwise(s["n"] + n).alias("n"),
        )

    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("now"), F.lit(0).alias("n"))
    return F.aggregate(F.split(c, r"\r?\n"), start, step, lambda s: F.concat(s["done"], F.array(s["now"])))


def generated(kind: str, rows: DataFrame, program: str, name: Column, text: Column) -> DataFrame:
    """Documents of a chunk type: (chunk_id, chunk_type, program, text)."""
    return rows.select(F.concat_ws(":", F.coalesce(program, F.lit("")), F.lit(kind), name).alias("chunk_id"), F.lit(kind).alias("chunk_type"), F.col(program).alias("program"), text.alias("text"))


def top_listing(rows: DataFrame, by: list[str], item: str, most: int) -> DataFrame:
    """(by, n, items): how many distinct items a group has, and the first of them in order.

    Items are cut to `most` by a limit within the window, before they are collected, so a hot group fills no row."""
    d = rows.filter(F.col(item).isNotNull()).select(*by, item).distinct()
    first = d.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(item))).filter(F.col("_r") <= most)
    return d.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).join(first.groupBy(*by).agg(F.sort_array(F.collect_list(item)).alias("items")), by)


def listed(n: Column, items: Column) -> Column:
    """The items joined by commas, and how many more there are."""
    return F.concat(F.array_join(items, ", "), F.when(n > F.size(items), F.concat(F.lit(" and "), (n - F.size(items)).cast("string"), F.lit(" more"))).otherwise(""))


def listing(items: Column, most: int) -> Column:
    """The first items joined by commas, and how many more there are."""
    return F.concat(F.array_join(F.slice(items, 1, most), ", "), F.when(F.size(items) > most, F.concat(F.lit(" … and "), (F.size(items) - most).cast("string"), F.lit(" more"))).otherwise(""))
