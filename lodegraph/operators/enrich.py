"""Enrichment of documents by the facts around them: callers, resolved targets, usage, parts, spanning trees."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodegraph.session import cut


def resolve_targets(calls: DataFrame, summaries: DataFrame) -> DataFrame:
    """(source, target, resolved): the chunk id of the target's summary, the least of several, else the raw name."""
    ids = summaries.groupBy(F.col("program").alias("target")).agg(F.min("chunk_id").alias("id"))
    return calls.select("source", "target").distinct().join(ids, "target", "left").select("source", "target", F.coalesce("id", "target").alias("resolved"))


def group_usage(members: DataFrame, uses: DataFrame, most: int = 10) -> DataFrame:
    """(group_id, n_users, users): who uses a variable group, the `most` frequent users, ties by name.

    members: program, group_id, variable. uses: program, variable, user."""
    u = members.join(uses, ["program", "variable"]).groupBy("group_id", "user").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("group_id").orderBy(F.desc("n"), "user")
    top = u.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= most)
    users = top.groupBy("group_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "user"))), lambda x: x["user"]), ",").alias("users"))
    return u.groupBy("group_id").agg(F.count(F.lit(1)).alias("n_users")).join(users, "group_id")


def parts(pieces: DataFrame, key: str, order: str, text: str, context: Column) -> DataFrame:
    """Pieces with their id key:part:i, their number and the context before the text of all but the first."""
    w = Window.partitionBy(key).orderBy(order)
    n = F.row_number().over(w)
    total = F.count(F.lit(1)).over(Window.partitionBy(key))
    p = pieces.withColumns({"part": n, "total_parts": total})
    body = F.when(F.col("part") > 1, F.concat(context, F.lit("\n"), F.col(text))).otherwise(F.col(text))
    return p.withColumns({"part_id": F.concat_ws(":", F.col(key).cast("string"), F.lit("part"), F.col("part").cast("string")), text: body})


def parse_coverage(lines: Column, affected: Column, unlocated: Column) -> Column:
    """Share of source lines that no error affects; an error without place counts three lines."""
    return F.when(lines > 0, F.greatest(lines - affected - 3 * unlocated, F.lit(0)) / lines)


def qualify(namespace: Column, name: Column) -> Column:
    return F.concat_ws(":", namespace, name)


def answered(prompts: DataFrame, cache: DataFrame, ask: Callable[[list[str]], list[str | None]]) -> DataFrame:
    """(key, hash, answer, from_cache): answers of a service, asked once per distinct prompt that no cache row has.

    prompts: key, prompt. cache: hash, answer. ask: answers of a batch of prompts, None for none; it is the
    plug-in, and runs in the workers. A null prompt has no answer."""
    import pyarrow as pa

    p = prompts.select("key", "prompt", F.substring(F.sha2("prompt", 256), 1, 16).alias("hash"))
    known = cache.filter("answer is not null").groupBy("hash").agg(F.min("answer").alias("answer"))
    open_ = p.filter("prompt is not null").select("hash", "prompt").dropDuplicates(["hash"]).join(known, "hash", "left_anti")

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ask(batch.column(1).to_pylist()), pa.string())], ["hash", "answer"])

    new = cut(open_.select("hash", "prompt").mapInArrow(run, "hash string, answer string"))
    every = known.withColumn("from_cache", F.lit(True)).unionByName(new.withColumn("from_cache", F.lit(False)))
    return p.select("key", "hash").join(every, "hash", "left").select("key", "hash", "answer", F.coalesce("from_cache", F.lit(False)).alias("from_cache"))


def flat_text(c: Column) -> Column:
    """All scalar values of JSON text, upper case, joined by blanks."""
    found = F.regexp_extract_all(F.regexp_replace(c, r'"(?:[^"\\]|\\.)*"\s*:', ""), F.lit(r'"((?:[^"\\]|\\.)*)"|(-?\d[\d.eE+-]*|true|false)'), F.lit(0))
    return F.upper(F.array_join(F.transform(found, lambda x: F.regexp_replace(x, '^"|"$', "")), " "))


def spanning_forest(edges: DataFrame) -> DataFrame:
    """(a, b, weight): minimum spanning forest of undirected weighted edges, by rounds of lightest edges.

    Every component takes its lightest edge to another (ties by ends) and merges along it, so that the
    number of components at least halves in a round. Weights are compared with their ends: no two are equal."""
    e = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "weight").filter("a <> b").groupBy("a", "b").agg(F.min("weight").alias("weight"))
    e = cut(e)
    label = cut(e.select(F.explode(F.array("a", "b")).alias("id")).distinct().withColumn("c", F.col("id")))
    out = None
    while True:
        la, lb = label.select(F.col("id").alias("a"), F.col("c").alias("ca")), label.select(F.col("id").alias("b"), F.col("c").alias("cb"))
        cross = cut(e.join(la, "a").join(lb, "b").filter("ca <> cb"))
        if cross.isEmpty():
            break
        ends = cross.select(F.explode(F.array("ca", "cb")).alias("c"), F.struct("weight", "a", "b", "ca", "cb").alias("m"))
        pick = cut(ends.groupBy("c").agg(F.min("m").alias("m")).select("m.*").distinct())
        new = pick.select("a", "b", "weight")
        out = new if out is None else out.unionByName(new)
        from lodegraph.operators.graph import components

        merged = components(pick.select(F.col("ca").alias("src"), F.col("cb").alias("dst"))).withColumnsRenamed({"id": "c", "component": "to"})
        label = cut(label.join(merged, "c", "left").select("id", F.coalesce("to", "c").alias("c")))
    return e.filter("false") if out is None else cut(out.distinct())


def tree_clusters(forest: DataFrame, k: int) -> DataFrame:
    """(id, cluster): components of a spanning forest without its k - 1 heaviest edges."""
    from lodegraph.operators.graph import components

    heavy = forest.orderBy(F.desc("weight"), "a", "b").limit(k - 1)
    kept = forest.join(heavy.select("a", "b"), ["a", "b"], "left_anti").select(F.col("a").alias("src"), F.col("b").alias("dst"))
    alone = heavy.select(F.explode(F.array("a", "b")).alias("src")).withColumn("dst", F.col("src"))
    return components(kept.unionByName(alone)).withColumnRenamed("component", "cluster")
