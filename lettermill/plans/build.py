"""The corpus build: raw mail to a leak-free, split dataset with statistics."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lettermill.config import CLASS_LABELS, BuildConfig
from lettermill.functions import text as X
from lettermill.operators import dedup, mime, similarity, split, stats
from lettermill.session import stored
from lettermill.sources import mail, sinks

#: Three-valued: true, false, or null where the language can't be told. Asked once for each distinct text.
LanguageTest = Callable[[Column], Column]


def every_language(text: Column) -> Column:
    """Without a detector every text passes but blank ones, of which nothing is known."""
    return F.when(F.trim(text) != "", F.lit(True))


@dataclass
class Build:
    records: DataFrame
    stats: dict


def parse_sources(spark: SparkSession, raw: str, cfg: BuildConfig, html_stripper: mime.HtmlStripper | None = None) -> tuple[DataFrame, list[str]]:
    files, skipped = mail.read_tree(spark, raw, cfg)
    parsed = mime.parsed_messages(files)
    parsed = parsed.withColumn("sender", F.col("parsed.sender")).withColumn("parse_error", F.col("parsed.parse_error"))
    rec = mime.epi_record(parsed, source=F.col("source"), label=F.col("label"), html_stripper=html_stripper)
    hard = (F.col("source") == cfg.hard_source) & (F.array_contains(F.split("path", "/"), cfg.hard_folder))
    return rec.withColumn("id", X.content_id(F.col("text"))).withColumn("_is_hard_ham", hard), skipped


def build_records(messages: DataFrame, cfg: BuildConfig | None = None, language: LanguageTest = every_language) -> tuple[DataFrame, dict]:
    """Filter, deduplicate, cluster, link and split parsed messages (see parse_sources for their columns).

    The language of a text is asked for once, however many messages have it; counters follow the order of a reader
    that asks first and drops duplicates then. With a limit for each source, `parsed` and the drop counters take in
    what was read up to each source's last kept message.
    """
    cfg = cfg or BuildConfig()
    rows = stored(messages)
    texts = rows.where("parse_error is null").select("id", "text").dropDuplicates(["id"])
    rows = stored(rows.join(texts.select("id", language(F.col("text")).alias("lang_ok")), "id", "left").select(*rows.columns, "lang_ok"))
    order = ["path_parts", "ord"]
    good = rows.where("parse_error is null and lang_ok")
    kept = stored(dedup.admit_by_source(good, key="id", source="source", order=order, limit=cfg.limit_per_source, sources=sorted(cfg.source_labels)))
    read = rows
    if cfg.limit_per_source:
        # a source that reached its limit was read no further than the last message kept
        ends = kept.groupBy("source").agg(F.count("*").alias("n"), F.max(F.struct("path_parts", "ord")).alias("end")).where(F.col("n") >= cfg.limit_per_source).drop("n")
        read = rows.join(F.broadcast(ends), "source", "left").where(F.col("end").isNull() | (F.struct("path_parts", "ord") <= F.col("end")))
    status = F.when(F.col("parse_error").isNotNull(), "dropped_non_email").when(F.col("lang_ok").isNull(), "dropped_empty_or_undetected").when(~F.col("lang_ok"), "dropped_non_english").otherwise("passed")
    counts = {r["status"]: r["n"] for r in stats.status_counts(read.select(status.alias("status"))).collect()}
    n_kept = kept.count()
    out: dict = {"parsed": sum(counts.values())}
    out |= {k: counts.get(k, 0) for k in ("dropped_non_email", "dropped_non_english", "dropped_empty_or_undetected")}
    out["dropped_duplicate"] = counts.get("passed", 0) - n_kept

    if cfg.near == "off":
        clusters = kept.select("id", F.col("id").alias("cluster"))
    else:
        clusters = stored(similarity.near_clusters(kept, method=cfg.near, threshold=cfg.near_threshold, permutations=cfg.near_permutations, k=cfg.shingle_words, seed=cfg.seed))
    sizes = similarity.cluster_sizes(clusters)
    out |= {"near_threshold": cfg.near_threshold, "near_clusters": sizes.count(), "near_largest": [r["n"] for r in stats.largest(sizes).collect()], "dropped_near_thinned": 0}
    if cfg.near_max_cluster:
        clusters = stored(dedup.thin(clusters, "cluster", cfg.near_max_cluster, "id"))
        kept = stored(kept.join(clusters.select("id"), "id", "left_semi"))
        out["dropped_near_thinned"] = n_kept - kept.count()

    edges = split.leak_edges(kept, clusters)
    members = kept.join(split.leak_components(kept, edges), "id").join(clusters, "id")
    hard = F.col("_is_hard_ham") if "_is_hard_ham" in kept.columns else F.lit(False)
    parts = split.component_summary(members, hard=hard)
    parts = stored(parts.withColumn("hard", F.col("hard") & (F.col("source") == cfg.hard_source)))
    placed = split.assign_splits(parts, ["label", "source", "hard"], val=cfg.val_fraction, test=cfg.test_fraction)
    records = stored(members.drop("split").join(placed.select("component", "split"), "component"))
    out["mixed_label_components"] = parts.where("mixed").count()
    out["near_clusters_leaked"] = split.leaked_clusters(records).count()
    out["kept"] = records.count()
    for sizes_ in stats.grouped_counts(records).collect():
        at = [sizes_[c] for c in ("source", "label", "split")]
        name = {(1, 0, 0): "by_source", (0, 1, 0): "by_label", (0, 0, 1): "by_split", (1, 0, 1): "by_source_split", (1, 1, 1): "by_source_label_split"}[tuple(int(x is not None) for x in at)]
        sep = "|" if name == "by_source_label_split" else "/"
        out.setdefault(name, {})[sep.join(x for x in at if x is not None)] = sizes_["n"]
    out["hard_ham_by_split"] = {r["split"]: r["n"] for r in stats.hard_by_split(records).collect()} if "_is_hard_ham" in records.columns else {}
    return records, out


def build_dataset(
    spark: SparkSession, raw: str, out_path: str | None = None, cfg: BuildConfig | None = None, language: LanguageTest = every_language, html_stripper: mime.HtmlStripper | None = None
) -> Build:
    """Read `raw`, build, and write the dataset as JSON lines if out_path is given."""
    cfg = cfg or BuildConfig()
    messages, skipped = parse_sources(spark, raw, cfg, html_stripper)
    records, out = build_records(messages, cfg, language)
    out["skipped_unknown_source"] = skipped
    if out_path is not None:
        sinks.write_dataset(records, out_path)
    return Build(records, out)


def import_classes(spark: SparkSession, folder: str, dataset: str, *, dry_run: bool = False, limit_per_class: int = 0, manifest: str | None = None) -> dict:
    """Take in ready synthetic mail: parse each class's messages, drop empty texts and those that the dataset or an
    earlier message has, and append the rest to the dataset's training part. Returns the statistics."""
    raw = mail.read_classes(spark, folder, limit_per_class)
    ranks = F.create_map(*[x for i, c in enumerate(CLASS_LABELS) for x in (F.lit(c), F.lit(i))])
    parsed = mime.parse_messages(raw)
    rec = mime.epi_record(parsed.withColumn("parse_error", F.col("parsed.parse_error")), source=F.lit("synthetic"), label=F.col("label"), split=F.lit("train"))
    rec = rec.withColumn("id", X.content_id(F.trim("text"))).withColumn("rank", ranks[F.col("class")])
    rec = stored(rec)
    usable = rec.where("parse_error is null and trim(text) <> ''")
    accepted = stored(dedup.not_yet_known(usable, mail.existing_ids(spark, dataset), "id", ["rank", "name"]).select(*mail.RECORD.names, "class"))
    classes = spark.createDataFrame(list(CLASS_LABELS.items()), "class string, label string")
    marks = rec.select("class", F.lit("read").alias("status")).unionByName(accepted.select("class", F.lit("accepted").alias("status")))
    per = {r["class"]: r for r in stats.class_counts(classes, marks).collect()}
    failed, empty, usable_n, n = rec.where("parse_error is not null").count(), rec.where("parse_error is null and trim(text) = ''").count(), usable.count(), accepted.count()
    out = {
        "generated": {c: r["generated"] - r["accepted"] for c, r in per.items()},  # marks are one a message read, one more if accepted
        "accepted": {c: r["accepted"] for c, r in per.items()},
        "dropped_dup": usable_n - n,
        "dropped_empty": empty,
        "failed": failed,
        "by_label": {label: sum(r["accepted"] for r in per.values() if r["label"] == label) for label in sorted(set(CLASS_LABELS.values()))},
    }
    real = stats.length_summary(mail.real_text_lengths(mail.read_dataset(spark, dataset))).first().asDict()
    out["lengths"] = {"synthetic": stats.length_summary(accepted.select(F.length("text").alias("n"))).first().asDict(), "real": real}
    sinks.append_records(accepted.select(*mail.RECORD.names), dataset, dry_run=dry_run)
    if manifest:
        sinks.write_manifest(spark, manifest, {"dry_run": dry_run, "results": out})
    return out


def runtime_records(messages: DataFrame, *, qr_decoder: mime.QrDecoder | None = None) -> DataFrame:
    """A detector's records of raw messages (column message); null fields for what can't be parsed."""
    return mime.runtime_record(mime.parse_messages(messages, qr_decoder=qr_decoder))
