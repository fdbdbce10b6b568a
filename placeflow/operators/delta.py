"""Corpus differences, generations, and what to rebuild."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def line_id(raw: Column) -> Column:
    """The first "id" of a line, '' without one."""
    return F.regexp_extract(raw, '"id":"([^"]*)"', 1)


def _lines(df: DataFrame) -> DataFrame:
    return df.where(F.trim("raw") != "").withColumn("doc_id", line_id(F.col("raw")))


def diff_keys(snapshot: DataFrame, fresh: DataFrame) -> DataFrame:
    """(seq, doc_id, change) of (seq, raw) lines, by 128 bits of hashes: no line is shuffled.

    Blank lines don't count. Of a repeated id the snapshot's last line holds; the first fresh line is compared
    with it, later ones are added. First and last lines are aggregates of numbers, so neither the lines of one id nor those
    without any meet in one task.
    """
    keys = lambda df: _lines(df).select("doc_id", "seq", F.xxhash64("raw").alias("h"), F.xxhash64(F.lit(1), "raw").alias("g"))
    pick = lambda f, n: (f("h", "seq").alias(f"{n}_h"), f("g", "seq").alias(f"{n}_g"))
    old = keys(snapshot).groupBy("doc_id").agg(F.max("seq").alias("old_seq"), *pick(F.max_by, "old"))
    new = keys(fresh)
    first = new.groupBy("doc_id").agg(F.min("seq").alias("seq"), *pick(F.min_by, "new"))
    both = first.join(old, "doc_id", "full_outer")
    same = (F.col("new_h") == F.col("old_h")) & (F.col("new_g") == F.col("old_g"))
    change = F.when(F.col("new_h").isNull(), "deleted").when(F.col("old_h").isNull(), "added").when(same, "unchanged").otherwise("changed")
    compared = both.select(F.coalesce("seq", "old_seq").alias("seq"), "doc_id", change.alias("change"))
    later = new.select("doc_id", "seq").join(first.select("doc_id", "seq"), ["doc_id", "seq"], "left_anti")
    return compared.unionByName(later.select("seq", "doc_id", F.lit("added").alias("change")))


def corpus_diff(snapshot: DataFrame, fresh: DataFrame) -> DataFrame:
    """(seq, doc_id, raw, change) of (seq, raw) lines: added, changed, unchanged, and deleted with the snapshot's line, by diff_keys().

    Lines are fetched for the keys that are asked for: a condition on `change` holds before it.
    """
    keys = diff_keys(snapshot, fresh)
    fetch = lambda some, df: some.join(_lines(df).select("doc_id", "seq", "raw"), ["doc_id", "seq"]).select("seq", "doc_id", "raw", "change")
    return fetch(keys.where("change <> 'deleted'"), fresh).unionByName(fetch(keys.where("change = 'deleted'"), snapshot))


def diff_summary(diff: DataFrame, *keys: str) -> DataFrame:
    counts = [F.count_if(F.col("change") == c).alias(c) for c in ("added", "changed", "deleted")]
    return diff.groupBy(*keys).agg(*counts, F.count_if(F.col("change") != "deleted").alias("fresh"))


def delta_lines(diff: DataFrame) -> DataFrame:
    """Changed and added lines, which a delta generation holds."""
    return diff.where(F.col("change").isin("changed", "added")).select("seq", "doc_id", "raw")


def refresh_decision(state: DataFrame, generations: int = 6, delta_ratio: float = 0.3, deleted_ratio: float = 0.005) -> DataFrame:
    """state plus `decision` (full, delta or noop) and `reason`, by the first rule that holds.

    state: has_base, builder_changed, stats_changed, has_snapshot, has_fresh, n_generations, added, changed, deleted, docs, deleted_pending, fresh.
    """
    docs = F.greatest(F.lit(1), F.coalesce(F.nullif("docs", F.lit(0)), "fresh"))
    changed = F.col("added") + F.col("changed")
    rules = [
        (~F.col("has_base"), "full", "no base"),
        (F.col("builder_changed"), "full", "builder changed"),
        (F.col("stats_changed"), "full", "statistics changed"),
        (~F.col("has_snapshot"), "full", "no snapshot"),
        (~F.col("has_fresh"), "full", "no fresh corpus"),
        (F.col("n_generations") + 1 > generations, "full", "too many generations"),
        (changed + F.col("deleted") == 0, "noop", "no change"),
        (changed / docs > delta_ratio, "full", "large delta"),
        ((F.col("deleted_pending") + F.col("deleted")) / docs > deleted_ratio, "full", "many deletions"),
    ]
    decision, reason = F.when(rules[0][0], rules[0][1]), F.when(rules[0][0], rules[0][2])
    for test, d, r in rules[1:]:
        decision, reason = decision.when(test, d), reason.when(test, r)
    return state.select("*", decision.otherwise("delta").alias("decision"), reason.otherwise("small delta").alias("reason"))


def stats_reasons(regions: DataFrame, stats: DataFrame, totals: DataFrame, drift: float = 0.1) -> DataFrame:
    """One row, reason: why the frozen statistics must be made anew (forced, missing, regions, drift), or null.

    regions, stats: region_id, stats without rows if there are none yet; totals: one row of forced, total, old_total.
    """
    there = stats.select("region_id", F.lit(True).alias("old")).distinct()
    own = regions.select("region_id", F.lit(True).alias("new")).distinct()
    sets = own.join(there, "region_id", "full_outer").agg(F.count_if(F.col("old").isNull() | F.col("new").isNull()).alias("unlike"), F.count("old").alias("known"))
    moved = F.abs(F.col("total") - F.col("old_total")) / F.greatest(F.lit(1), F.col("old_total")) > drift
    return sets.join(totals).select(F.when(F.col("forced"), "forced").when(F.col("known") == 0, "missing").when(F.col("unlike") > 0, "regions").when(moved, "drift").alias("reason"))


def stats_reason(regions: DataFrame, stats: DataFrame | None, total: int, old_total: int, forced: bool = False, drift: float = 0.1) -> str | None:
    """The reason of stats_reasons() for figures at hand."""
    spark = regions.sparkSession
    known = regions.select("region_id").limit(0) if stats is None else stats
    return stats_reasons(regions, known, spark.createDataFrame([(forced, total, old_total)], "forced boolean, total long, old_total long"), drift).first().reason


def deleted_pending(generations: DataFrame) -> DataFrame:
    """(region_id, deleted_pending): deletions of a region's deltas (region_id, generation, full, deleted) since its last full build."""
    last = generations.groupBy("region_id").agg(F.max(F.when(F.col("full"), F.col("generation"))).alias("base"))
    since = generations.join(last, "region_id").where(F.col("base").isNull() | (F.col("generation") > F.col("base"))).groupBy("region_id").agg(F.sum("deleted").alias("d"))
    return last.join(since, "region_id", "left").select("region_id", F.coalesce("d", F.lit(0)).alias("deleted_pending"))


def current_corpus(generations: DataFrame) -> DataFrame:
    """The lines in force over base and deltas (doc_id, generation, seq, raw): of each id the last line of its latest generation; deletions wait for a full rebuild.

    A delta's line replaces earlier lines of its id, and only these. Lines without an id replace nothing and are
    replaced by nothing: each stays until the next full build. The last line is an aggregate, so an id that many lines share isn't gathered.
    """
    rest = [c for c in generations.columns if c != "doc_id"]
    named = F.coalesce(F.col("doc_id"), F.lit("")) != ""
    last = generations.where(named).groupBy("doc_id").agg(F.max_by(F.struct(*rest), F.struct("generation", "seq")).alias("r")).select("doc_id", "r.*")
    return last.select(generations.columns).unionByName(generations.where(~named))


def bootstrap_pending(state: DataFrame) -> DataFrame:
    """One row: whether every region has a corpus and some region is unbuilt or unpublished. state: has_corpus, built, uploaded."""
    unfinished = F.col("built").isNull() | ~F.col("built").eqNullSafe(F.col("uploaded"))
    return state.agg((F.bool_and("has_corpus") & F.bool_or(unfinished)).alias("bootstrap_pending"))


def stale_regions(state: DataFrame) -> DataFrame:
    """region_id, needs_build (required and built fingerprints differ), needs_upload (built and uploaded differ)."""
    return state.select("region_id", (~F.col("required").eqNullSafe(F.col("built"))).alias("needs_build"), (F.col("built").isNotNull() & ~F.col("built").eqNullSafe(F.col("uploaded"))).alias("needs_upload"))


def hydrate_state(state: DataFrame, meta: DataFrame) -> DataFrame:
    """Document counts filled in: state, else enrichment, else extract, else manifest, else 0; source version and bytes likewise. By region_id."""
    filled = state.join(meta, "region_id", "left")
    some = lambda *c: F.coalesce(*(F.nullif(x, F.lit(0)) for x in c), F.lit(0))
    return filled.select("region_id", some("docs", "enriched_docs", "extract_docs", "manifest_docs").alias("docs"), F.coalesce("version", "meta_version").alias("version"), some("bytes", "meta_bytes").alias("bytes"))


def corpus_validity(state: DataFrame) -> DataFrame:
    """region_id, reasons (why a corpus can't be used), valid. state: schema, total_docs, identity, meta_identity, addresses, meta_addresses, has_output."""
    reasons = F.array_compact(
        F.array(
            F.when(~F.col("schema").eqNullSafe(F.lit(1)), "schema"),
            F.when(F.coalesce("total_docs", F.lit(0)) <= 0, "documents"),
            F.when(~F.col("identity").eqNullSafe(F.col("meta_identity")), "source"),
            F.when(~F.col("addresses").eqNullSafe(F.col("meta_addresses")), "addresses"),
            F.when(~F.coalesce("has_output", F.lit(False)), "output"),
        )
    )
    return state.select("region_id", reasons.alias("reasons"), (F.size(reasons) == 0).alias("valid"))


def source_changed(sources: DataFrame) -> DataFrame:
    """source_id, changed: the config must match; then etags decide if both are known; else dates, with sizes equal or unknown (0)."""
    p, c = (lambda n: F.col(f"prev_{n}")), F.col
    size = (p("bytes") == c("bytes")) | (F.coalesce(p("bytes"), F.lit(0)) == 0) | (F.coalesce(c("bytes"), F.lit(0)) == 0)
    same = F.when(~p("config").eqNullSafe(c("config")), False).when(p("etag").isNotNull() & c("etag").isNotNull(), p("etag") == c("etag")).otherwise(p("modified").eqNullSafe(c("modified")) & p("modified").isNotNull() & size)
    return sources.select("source_id", (~same).alias("changed"))


def resume_state(previous: DataFrame, regions: DataFrame, signature: str, schema: int = 1) -> DataFrame:
    """Completed region ids to keep: those of a run with the same signature and schema that are still configured, each once. previous: signature, schema, completed."""
    same = previous.where((F.col("signature") == signature) & (F.col("schema") == schema))
    return same.select(F.explode("completed").alias("region_id")).distinct().join(regions.select("region_id"), "region_id", "left_semi")


def apply_results(state: DataFrame, results: DataFrame) -> DataFrame:
    """(region_id, completed, attempt, message): a success removes the failure, a failure keeps its attempt and 500 characters of its message."""
    both = state.select("region_id", F.col("completed").alias("was"), F.col("attempt").alias("old_attempt"), F.col("message").alias("old_message")).join(results, "region_id", "full_outer")
    ok, new = F.coalesce("ok", F.lit(False)), F.col("ok").isNotNull()
    return both.select("region_id", F.when(new, ok).otherwise(F.col("was")).alias("completed"), F.when(new & ~ok, F.col("attempt")).when(~new, F.col("old_attempt")).alias("attempt"), F.when(new & ~ok, F.substring("message", 1, 500)).when(~new, F.col("old_message")).alias("message"))
