"""Template-generated corpus rows and the fallback rules around them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deskloom import schemas
from deskloom.functions.text import fill_slots, numbered_id, pick
from deskloom.presets import cases, taxonomy
from deskloom.sources.files import choose_csv, scan_messages_csv
from deskloom.sources.literals import seed_cases


def _nested(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def template_columns(id_col: Column, templates=cases.TEMPLATES, devices=cases.DEVICES,
                     os_versions=cases.OS_VERSIONS, handle: str = taxonomy.BRAND_HANDLE) -> dict[str, Column]:
    """Corpus columns of a generated row: class, template of that class and slot fillers picked by id hash.

    The template table is a constant array of the plan, so generation is row-local at any number of rows.
    """
    classes = list(templates)
    cls = F.get(_nested(classes), pick(id_col, "class", len(classes)))
    device = F.get(_nested(devices), pick(id_col, "device", len(devices)))
    os_ver = F.get(_nested(os_versions), pick(id_col, "os", len(os_versions)))
    entry = None
    for name, rows in templates.items():
        options = F.array(*[F.struct(F.lit(c).alias("customer"), F.lit(a).alias("agent"),
                                     F.lit(h).alias("auto"), F.lit(r).alias("reason")) for c, a, h, r in rows])
        chosen = F.get(options, pick(id_col, "template", len(rows)))
        entry = F.when(cls == name, chosen) if entry is None else entry.when(cls == name, chosen)
    return {
        "customer_text": F.concat(F.lit(handle + " "), fill_slots(entry["customer"], device=device, os_ver=os_ver)),
        "intent": cls,
        "agent_text": fill_slots(entry["agent"], device=device, os_ver=os_ver),
        "auto_handle": entry["auto"],
        "escalation_reason": entry["reason"],
        "source": F.lit(cases.SYNTHETIC_SOURCE),
    }


def generate_rows(ids: DataFrame, id_col: str, first: int = 0, **kwargs) -> DataFrame:
    """One generated corpus row per id; ``first`` is added to the number in the row's own id."""
    columns = template_columns(F.col(id_col), **kwargs)
    return ids.select(numbered_id("synth_", F.col(id_col) + first).alias("id"), *[c.alias(n) for n, c in columns.items()])


def expand_templates(spark: SparkSession, total: int) -> DataFrame:
    """Seed rows first (all of them, even if ``total`` is smaller), then generated rows up to ``total``."""
    seeds = seed_cases(spark)
    n_seeds = len(cases.SEED_CASES)
    ids = spark.range(n_seeds, max(n_seeds, total))
    return seeds.unionByName(generate_rows(ids, "id"))


def top_up_pairs(pairs: DataFrame, max_pairs: int, minimum: int = 50) -> DataFrame:
    """Pairs as they are if at least ``minimum`` exist, else filled up with generated rows.

    The count stops after ``minimum`` rows. Ids of generated rows come along for the later numbering step.
    """
    found = pairs.limit(minimum).count()
    tagged = pairs.withColumn("synth_id", F.lit(None).cast("string"))
    if found >= minimum:
        return tagged
    extra = expand_templates(pairs.sparkSession, max_pairs - found).select(
        "customer_text", "agent_text", "source", F.col("id").alias("synth_id"))
    return tagged.unionByName(extra, allowMissingColumns=True)


def messages_or_synthetic(spark: SparkSession, folder: str | None, max_pairs: int,
                          build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Corpus built from the folder's CSV, or the generated corpus with its own labels if there is none."""
    path = choose_csv(spark, folder) if folder else None
    return expand_templates(spark, max_pairs) if path is None else build(scan_messages_csv(spark, path))


CORPUS_COLUMNS = [field.split()[0] for field in schemas.CORPUS.split(", ")]
