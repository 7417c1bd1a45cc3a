"""Lookups in a registry and gated registration of new versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from schemaflow.functions.canonical import canonical, fingerprint
from schemaflow.functions.schema_docs import DOC_TYPE, let, schema_doc, valid_doc
from schemaflow.operators.compat import VIOLATION_TYPE, check, invalid, report, reports, violations
from schemaflow.session import scratch_dir
from schemaflow.sources.registry import read_registry, read_schema_file, store_registry
from schemaflow.storage import make_directory, put_if_absent

# Candidates of a subject that are folded in one row; more are folded block by block.
SEQUENCE_BLOCK = 256


def subjects(registry: DataFrame) -> DataFrame:
    return registry.select("subject").distinct()


def versions(registry: DataFrame, subject: str) -> DataFrame:
    """Versions of one subject, oldest first by number; empty for an unknown subject."""
    return registry.filter(F.col("subject") == subject).orderBy("version")


def latest(registry: DataFrame) -> DataFrame:
    """The newest version of every subject and how many it has."""
    newest = registry.groupBy("subject").agg(
        F.max(F.struct("version", "schema")).alias("newest"), F.count(F.lit(1)).alias("versions")
    )
    return newest.select("subject", F.col("newest.version").alias("version"), "newest.schema", "versions")


def fingerprints(registry: DataFrame) -> DataFrame:
    """subject, version, schema, canonical form and fingerprint of every version; null where a text is no schema."""
    known = registry.select("subject", "version", "schema", canonical(F.col("schema")).alias("canonical"))
    return known.withColumn("fingerprint", fingerprint(F.col("canonical")))


def layouts(registry: DataFrame, newest: bool = False) -> DataFrame:
    """One version of each layout of a subject: the first of those with one fingerprint, or the last if ``newest``."""
    chosen = F.max if newest else F.min
    found = fingerprints(registry).groupBy("subject", "fingerprint").agg(
        chosen(F.struct("version", "schema")).alias("of"), F.count(F.lit(1)).alias("versions")
    )
    return found.select("subject", "fingerprint", F.col("of.version").alias("version"), "of.schema", "versions")


def reader_and_writers(registry: DataFrame, subject: str, newest: bool = False) -> tuple[str, list[str]]:
    """Latest schema of a subject and the layouts that earlier ones wrote, oldest first; no versions is an error.

    These texts are the decoder's settings, which is why they come to the driver. Versions of one canonical form write alike, so the
    earliest of them stands for all: a later one would be tried on the same rows and fail again. Those that write like the
    latest, which is tried first, are left out too. ``newest`` orders layouts by their last version, for candidates that are
    tried newest first.
    """
    of_subject = registry.filter(F.col("subject") == subject).select("subject", "version", "schema")
    known = layouts(of_subject, newest).withColumnRenamed("version", "at")
    last = of_subject.orderBy(F.desc("version")).limit(1).withColumnRenamed("schema", "latest")
    last = last.select("latest", fingerprint(canonical(F.col("latest"))).alias("own"))
    # The latest version is one row.
    rows = known.join(F.broadcast(last), F.lit(True)).orderBy("at").collect()
    if not rows:
        raise ValueError(f"no schemas registered for subject {subject}")
    return rows[0]["latest"], [r["schema"] for r in rows if r["fingerprint"] != r["own"]]


def _with_latest(offered: DataFrame, registry: DataFrame) -> DataFrame:
    """Adds doc of a subject's latest version (which must be valid), its number ``top``, and the count of ``versions``, or nulls."""
    columns = ["version", "schema", *(["doc"] if "doc" in registry.columns else [])]
    newest = registry.groupBy("subject").agg(
        F.max(F.struct("version", F.struct(*columns).alias("of"))).alias("newest"), F.count(F.lit(1)).alias("versions")
    )
    # Both sides grow with the registry, and compressed files make them look small enough to broadcast.
    both = offered.join(newest.hint("merge"), "subject", "left")
    doc = F.col("newest.of.doc") if "doc" in columns else schema_doc(F.col("newest.of.schema"))
    both = both.withColumns({"top": F.col("newest.version"), "doc": doc}).drop("newest")
    return both.withColumn("doc", valid_doc(F.col("doc"), F.col("subject")))


def _problem(schema: Column, doc: Column) -> Column:
    return F.when(schema.isNull(), "there is no schema text").otherwise(doc["problem"])


def register(registry: DataFrame, candidates: DataFrame, level: str = "backward") -> DataFrame:
    """Decide on one candidate schema per subject.

    A text that is no valid schema is refused. A first version is otherwise accepted unchecked; a later one is checked against
    the latest only, which must be valid itself. Each row has ``accepted``,
    the ``version`` it gets (count of versions plus one, null if refused), and the ``violations`` and their report.
    Several candidates for one subject raise, as the outcome would depend on their order: :func:`register_sequence` takes them.
    """
    single = candidates.groupBy("subject").agg(F.min("schema").alias("schema"), F.count(F.lit(1)).alias("_n"))
    several = F.raise_error(F.concat(F.lit("more than one candidate for subject "), F.col("subject")))
    single = single.withColumn("schema", F.when(F.col("_n") > 1, several.cast("string")).otherwise(F.col("schema")))
    both = _with_latest(single.drop("_n"), registry).withColumn("_new", schema_doc(F.col("schema")))
    problem = _problem(F.col("schema"), F.col("_new"))
    found = (
        F.when(problem.isNotNull(), invalid(problem))
        .when(F.col("versions").isNull(), violations(F.col("doc"), F.col("_new"), "none"))
        .otherwise(violations(F.col("doc"), F.col("_new"), level))
    )
    accepted = F.size("violations") == 0
    return both.withColumn("violations", found).select(
        "subject",
        "schema",
        accepted.alias("accepted"),
        F.when(accepted, (F.coalesce("versions", F.lit(0)) + 1).cast("int")).alias("version"),
        "violations",
        report(F.col("violations")).alias("report"),
        F.col("top").alias("latest_version"),
    )


STATE = f"struct<doc:{DOC_TYPE},versions:bigint,decided:array<struct<at:bigint,accepted:boolean,version:int,violations:array<{VIOLATION_TYPE}>>>>"


def _folded(offered: Column, doc: Column, versions: Column, level: str) -> Column:
    """Struct STATE after the candidates of an ordered array (at, schema, doc), each against the last one accepted."""

    def decide(state: Column, one: Column) -> Column:
        problem = _problem(one["schema"], one["doc"])
        found = (
            F.when(problem.isNotNull(), invalid(problem))
            .when(state["doc"].isNull(), violations(state["doc"], one["doc"], "none"))
            .otherwise(violations(state["doc"], one["doc"], level))
        )

        def next_state(found: Column) -> Column:
            accepted = F.size(found) == 0
            number = state["versions"] + 1
            decision = F.struct(
                one["at"].alias("at"),
                accepted.alias("accepted"),
                F.when(accepted, number).cast("int").alias("version"),
                found.alias("violations"),
            )
            return F.struct(
                F.when(accepted, one["doc"]).otherwise(state["doc"]).alias("doc"),
                F.when(accepted, number).otherwise(state["versions"]).alias("versions"),
                F.concat(state["decided"], F.array(decision)).alias("decided"),
            ).cast(STATE)

        return let(found, next_state)

    start = F.struct(doc.alias("doc"), versions.alias("versions"), F.array().alias("decided")).cast(STATE)
    return F.aggregate(offered, start, decide)


def register_sequence(registry: DataFrame, candidates: DataFrame, level: str = "backward") -> DataFrame:
    """Decide on several ordered candidates of each subject: columns subject, ord and schema.

    Each is checked against the last one accepted before it, at first the latest version; otherwise as :func:`register`, whose columns
    come back with ``ord``. Equal numbers ``ord`` are ordered by text; a null one comes first. The decisions of a subject depend
    on each other, so they are one fold over an array, whose state is the last accepted schema; more than SEQUENCE_BLOCK
    candidates of a subject take several rounds, of which each holds one block of them. Decisions keep the columns of their
    candidates, so that these are not joined again, and nothing is broadcast. No candidates give no rows.
    """
    order = Window.partitionBy("subject").orderBy("ord", "schema")
    numbered = candidates.select("subject", "ord", "schema", (F.row_number().over(order) - 1).cast("long").alias("at"))
    numbered = _stored(numbered.withColumn("doc", schema_doc(F.col("schema"))), "candidates")
    last = numbered.agg(F.max("at")).first()[0]
    state = _with_latest(numbered.select("subject").distinct(), registry)
    state = state.withColumn("versions", F.coalesce("versions", F.lit(0)).cast("long"))
    decided = None
    for first in range(0, (last or 0) + 1, SEQUENCE_BLOCK):
        block = numbered.filter(F.col("at").between(first, first + SEQUENCE_BLOCK - 1))
        offered = block.groupBy("subject").agg(F.sort_array(F.collect_list(F.struct("at", "ord", "schema", "doc"))).alias("offered"))
        folded = _folded(F.col("offered"), F.col("doc"), F.col("versions"), level)
        rows = state.join(offered.hint("merge"), "subject", "left").select(
            "subject",
            "top",
            F.transform("offered", lambda one: F.struct(one["ord"].alias("ord"), one["schema"].alias("schema"))).alias("offered"),
            F.when(F.col("offered").isNotNull(), folded).alias("after"),
            "doc",
            "versions",
        )
        rows = _stored(rows, "sequence")
        # Decisions are in the order of the candidates.
        both = F.arrays_zip("offered", "after.decided")
        found = rows.select("subject", "top", F.explode(both).alias("of")).select("subject", "top", "of.offered.*", "of.decided.*")
        decided = found if decided is None else decided.unionByName(found)
        state = rows.select(
            "subject",
            "top",
            F.when(F.col("after").isNull(), F.col("doc")).otherwise(F.col("after.doc")).alias("doc"),
            F.coalesce("after.versions", "versions").alias("versions"),
        )
    return decided.select(
        "subject",
        "ord",
        "schema",
        "accepted",
        "version",
        "violations",
        report(F.col("violations")).alias("report"),
        F.col("top").alias("latest_version"),
    )


def _stored(rows: DataFrame, label: str) -> DataFrame:
    path = scratch_dir(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def publish(spark: SparkSession, root: str, candidates: DataFrame, level: str = "backward") -> DataFrame:
    """Register ordered candidates (subject, ord, schema) in the directory at ``root``; returns the decisions.

    Accepted ones become ``<root>/<subject>/v<n>.avsc``, each created only if no such file exists. Where another writer was first,
    that subject's candidates from there on are decided again, against what the other one registered, so two writers never
    share a number and neither stores what its winner rules out. A gap in a subject's numbers raises, as its next
    number is taken. Subjects name directories: without ``/``, and not starting with ``.`` or ``_``. The driver makes one call for
    each accepted version, in order, and holds the subjects it lost.
    """
    make_directory(spark, root)
    odd = F.col("subject").rlike("/|^[._]|^$") | F.col("subject").isNull()
    name = F.when(odd, F.raise_error(F.concat(F.lit("no directory name: "), F.coalesce("subject", F.lit("null")))).cast("string"))
    waiting = candidates.select(name.otherwise(F.col("subject")).alias("subject"), "ord", "schema")
    final, lost_before = None, {}
    while True:
        decided = _stored(register_sequence(read_registry(spark, root), waiting, level), "decided")
        lost: dict[str, int] = {}
        for row in decided.filter("accepted").orderBy("subject", "version").toLocalIterator():
            subject, version = row["subject"], row["version"]
            if subject in lost or put_if_absent(spark, f"{root}/{subject}/v{version}.avsc", row["schema"]):
                continue
            if lost_before.get(subject) == version:
                raise ValueError(f"version number already in use for subject {subject}")
            lost[subject] = version
        if not lost:
            return decided if final is None else final.unionByName(decided)
        lost_before = lost
        missed = spark.createDataFrame(list(lost.items()), "subject string, lost int")
        marked = decided.join(missed, "subject", "left")
        # Candidates in front of the lost one stay decided; that one and those behind it do not.
        place = F.struct(F.col("ord").alias("ord"), F.col("schema").alias("schema"))
        first_lost = marked.filter(F.col("version") == F.col("lost")).select("subject", place.alias("first_lost"))
        behind = F.when(F.col("accepted"), F.col("version") >= F.col("lost")).otherwise(place >= F.col("first_lost"))
        again = F.coalesce(behind, F.lit(False))
        marked = marked.join(first_lost, "subject", "left").withColumn("again", again)
        kept = _stored(marked.filter("not again").select(*decided.columns), "decided")
        final = kept if final is None else final.unionByName(kept)
        waiting = _stored(marked.filter("again").select("subject", "ord", "schema"), "waiting")


def store_accepted(decided: DataFrame, root: str) -> None:
    """Append the accepted schemas to the registry at ``root``; nothing is stored for the others.

    Raises where a gap in a subject's numbers would make the new version replace an existing one.
    """
    taken = F.raise_error(F.concat(F.lit("version number already in use for subject "), F.col("subject")))
    clash = F.col("latest_version") >= F.col("version")
    numbered = decided.filter("accepted").withColumn(
        "version", F.when(clash, taken.cast("int")).otherwise(F.col("version"))
    )
    store_registry(numbered, root)


def check_files(spark: SparkSession, old_path: str, new_path: str, level: str = "backward") -> DataFrame:
    """Report and status for two schema files."""
    old = read_schema_file(spark, old_path).select(F.col("schema").alias("old_schema"))
    new = read_schema_file(spark, new_path).select(F.col("schema").alias("new_schema"))
    # One row each.
    return reports(check(old.join(new, F.lit(True)), level))
