"""The whole scan as one lazy plan per result table."""

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codesieve import vocab
from codesieve.functions import paths as P
from codesieve.functions.sizes import broadcast_if_small
from codesieve.operators import detectors as D
from codesieve.operators import file_pass as FP
from codesieve.operators import findings as FD
from codesieve.operators import inventory as I
from codesieve.operators import lines as L
from codesieve.operators import options as O
from codesieve.operators import rules as RU
from codesieve.operators import scoring as SC
from codesieve.operators.patterns import builtin_patterns, compiled_rules, shipped_patterns
from codesieve.operators.rule_tables import TablePart
from codesieve.sources import records as RC
from codesieve.sources import reports as RP
from codesieve.sources import trees as TR
from codesieve.sources.rules import shipped_rules


# Project profiles up to this size travel to the files; larger ones are joined by a shuffle.
BROADCAST_BYTES, BROADCAST_ROWS = 64 * 1024 * 1024, 100_000


def measured(profiles: DataFrame) -> DataFrame:
    """Profiles with a hint to broadcast them if they are few, else as they are.

    Left alone Spark would shuffle the source text before it learns that the profiles are few.
    Measuring them reads paths only.
    """
    small = broadcast_if_small(profiles, BROADCAST_ROWS, BROADCAST_BYTES)
    return profiles if small is None else small


def discover(
    files: DataFrame,
    options: DataFrame | None = None,
    extensions: list[str] | None = None,
    exclusion_mode: str = "substring",
    profiles: DataFrame | None = None,
    is_measured: bool = False,
) -> DataFrame:
    """Files a scan looks at, with their language and the size limit of their project.

    Project profiles have one row per project, and may name `excluded_paths` of their own.
    They are broadcast when their measured size allows it; beyond that the files are shuffled
    by project, and AQE splits a huge project. `is_measured`: profiles come from `measured`.
    """
    profiles = I.detect_languages(files) if profiles is None else profiles
    limits = ["max_file_size_mb", "max_depth"]
    if options is not None:
        profiles = profiles.join(O.clamp_options(options).select("project_id", *limits), "project_id", "left")
    else:
        profiles = profiles.withColumns({n: F.lit(None).cast("double") for n in limits})
    # A project without a row or a value of its own has the default.
    defaults = {n: F.coalesce(n, F.lit(vocab.OPTION_BOUNDS[n][2]).cast("double")) for n in limits}
    profiles = profiles.withColumns(defaults)
    if options is not None or not is_measured:
        profiles = measured(profiles)
    wanted = extensions or vocab.INCLUDED_EXTENSIONS
    by_path = (
        P.extension(F.col("path")).isin(*wanted) & ~I.default_excluded(F.col("path"))
    )
    exclusion = I.excluded_by_language(F.col("path"), F.col("primary_language"), exclusion_mode)
    if "excluded_paths" in profiles.columns:
        own = I.custom_excluded(F.col("path"), F.col("excluded_paths"), exclusion_mode)
        exclusion = exclusion | F.coalesce(own, F.lit(False))
    return (
        files.where(by_path).join(profiles, "project_id")
        .where(I.included(F.col("path"), F.col("target_languages"), exclusion, wanted))
        .where(I.within_depth(F.col("path"), F.col("max_depth")))
        .withColumn("language", P.language(F.col("path")))
        .drop("primary_language", "target_languages", "max_depth", "excluded_paths")
    )


def split_oversize(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    limit = F.col("max_file_size_mb") * 1024 * 1024
    kept, errors = I.split_by_size(found, limit)
    return kept.drop("max_file_size_mb"), errors


def compile_rules(rules: DataFrame | None = None) -> list:
    """Built-in patterns, then those of the rules (of the packaged rules if none are given)."""
    return builtin_patterns() + (shipped_patterns() if rules is None else compiled_rules(rules))


def one_pass(patterns: list, detectors: tuple) -> bool:
    """Whether all detectors are known to the pass over files, with at most one part of a rule table to hold."""
    return set(detectors) <= set(D.DEFAULT) and sum(isinstance(p, TablePart) for p in patterns) <= 1


def findings_of(files: DataFrame, patterns: list, detectors: tuple = D.DEFAULT, keep: str = "first") -> DataFrame:
    """De-duplicated findings: in one pass over the files, or by a shuffle of the findings of several passes.

    (project_id, path) names a file once.
    """
    if one_pass(patterns, detectors):
        return FP.findings_of(FP.analyze(files, patterns, tuple(d.name for d in detectors), keep))
    return FD.dedup(detect(files, patterns, detectors), keep)


def detect(
    files: DataFrame, patterns: list, detectors: tuple = D.DEFAULT
) -> DataFrame:
    """All findings of all detectors, before de-duplication."""
    parts = []
    for d in detectors:
        mine = files.where(F.col("language").isin(*d.languages)) if d.languages else files
        parts.append(d.detect(mine, patterns))
    return FD.union_findings(*parts)


def known_language() -> F.Column:
    return F.col("language") != vocab.UNKNOWN_LANGUAGE


def unsupported_projects(profiles: DataFrame, found: DataFrame) -> DataFrame:
    """Projects without a single file to analyze: an error row instead of a perfect score."""
    supported = found.where(known_language()).select("project_id").distinct()
    return (
        profiles.select("project_id")
        .join(supported, "project_id", "left_anti")
        .select(
            "project_id",
            F.lit(None).cast("string").alias("path"),
            F.lit("unsupported_language").alias("reason"),
            F.lit(None).cast("string").alias("message"),
        )
    )


def scan_stats(
    kept: DataFrame, skipped: DataFrame, findings: DataFrame, applied: DataFrame
) -> DataFrame:
    """Files analyzed and skipped, lines scanned, rules applied and triggered per project."""
    counted = (
        L.line_counts(kept, "project_id")
        .groupBy("project_id")
        .agg(
            F.count("*").alias("files_analyzed"),
            F.sum("n_newlines").alias("total_lines_scanned"),
        )
    )
    return _stats_of(applied, counted.join(SC.rules_triggered(findings), "project_id", "left"), skipped)


def _stats_of(applied: DataFrame, counted: DataFrame, skipped: DataFrame) -> DataFrame:
    skipped = skipped.groupBy("project_id").agg(F.count("*").alias("files_skipped"))
    return (
        applied.join(counted, "project_id", "left")
        .join(skipped, "project_id", "left")
        .fillna(0)
        .select(
            "project_id",
            "files_analyzed",
            "files_skipped",
            "rules_applied",
            "rules_triggered",
            "total_lines_scanned",
        )
    )


def rules_applied(profiles: DataFrame, rules: DataFrame) -> DataFrame:
    """Number of rules that apply to each project."""
    counted = RU.rules_for_projects(profiles, rules).groupBy("project_id").agg(
        F.count("*").alias("rules_applied")
    )
    return profiles.select("project_id").join(counted, "project_id", "left").fillna(0)


def fact_problems(kept: DataFrame) -> DataFrame:
    """Error rows of kept files whose content is missing or whose syntax could not be followed."""
    return FP.problems_of(FP.analyze(kept, [], (D.PYTHON_SYNTAX.name,)))


def file_accounting(files: DataFrame, found: DataFrame, skipped: DataFrame, errors: DataFrame) -> DataFrame:
    """Per project: files in, analyzed, excluded, of unknown language, and errors by reason.

    Every file is in exactly one of these; `errors` has file rows with a reason.
    """
    per_reason = [F.count_if(F.col("reason") == r).alias(r) for r in vocab.FILE_ERRORS]
    lost = errors.where(F.col("path").isNotNull()).groupBy("project_id").agg(*per_reason)
    return (
        files.groupBy("project_id").agg(F.count("*").alias("files_in"))
        .join(found.groupBy("project_id").agg(F.count("*").alias("n_found")), "project_id", "left")
        .join(skipped.groupBy("project_id").agg(F.count("*").alias("unknown_language")), "project_id", "left")
        .join(lost, "project_id", "left")
        .fillna(0)
        .withColumn("excluded", F.col("files_in") - F.col("n_found"))
        .withColumn("analyzed", sum((-F.col(c) for c in ["unknown_language", *vocab.FILE_ERRORS]), F.col("n_found")))
        .select("project_id", "files_in", "analyzed", "excluded", "unknown_language", *vocab.FILE_ERRORS)
    )


def summary_of(findings: DataFrame, profiles: DataFrame, unsupported: DataFrame) -> DataFrame:
    """Classified summary; a project that could not be analyzed has no score and no verdict."""
    flags = unsupported.select("project_id", F.lit(True).alias("unsupported"))
    summary = SC.report_summary(findings, profiles).join(flags, "project_id", "left")
    score = F.when(F.col("unsupported").isNull(), F.col("security_score"))
    classified = SC.classify(summary.withColumn("security_score", score))
    verdict = {c: F.when(F.col("unsupported").isNull(), F.col(c)) for c in ("gate_code", "is_clean", "has_critical_issues")}
    return classified.withColumns(verdict).drop("unsupported")


class Scan:
    """Findings, errors, summary and stats of all projects in `files`, each a lazy table.

    `write` stores the findings once; what is asked for afterwards reads them back instead of
    scanning the sources again.
    """

    def __init__(
        self,
        files: DataFrame,
        rules: DataFrame | None = None,
        options: DataFrame | None = None,
        extensions: list[str] | None = None,
        exclusion_mode: str = "substring",
        keep: str = "first",
        policy: dict | None = None,
        detectors: tuple = D.DEFAULT,
        profiles: DataFrame | None = None,
        opener: Callable[[DataFrame], DataFrame] | None = None,
    ):
        """`opener` gives file rows without content their content; it sees only files that are analyzed."""
        self.keep, self.policy, self.detectors, self.written = keep, policy, detectors, False
        self.rules, self.files = rules, files
        self.profiles = measured(I.detect_languages(files) if profiles is None else profiles)
        self.found = discover(files, options, extensions, exclusion_mode, self.profiles, True)
        within, self.oversize = split_oversize(self.found)
        # Files no detector knows (a project of nothing but such files) are skipped.
        self.kept = within.where(known_language())
        if opener is not None:
            self.kept = opener(self.kept)
        self.unknown = within.where(~known_language())
        self.skipped = self.oversize.select("project_id", "path").unionByName(
            self.unknown.select("project_id", "path")
        )

    @cached_property
    def patterns(self) -> list:
        return compile_rules(self.rules)

    @cached_property
    def findings(self) -> DataFrame:
        found = findings_of(self.kept, self.patterns, self.detectors, self.keep)
        return FD.apply_policy(found, **self.policy) if self.policy else found

    @cached_property
    def unsupported(self) -> DataFrame:
        return unsupported_projects(self.profiles, self.found)

    @cached_property
    def errors(self) -> DataFrame:
        return self.oversize.unionByName(self.problems).unionByName(self.unsupported)

    @cached_property
    def problems(self) -> DataFrame:
        return fact_problems(self.kept)

    @cached_property
    def accounting(self) -> DataFrame:
        return file_accounting(self.files, self.found, self.unknown, self.oversize.unionByName(self.problems))

    @cached_property
    def summary(self) -> DataFrame:
        return summary_of(self.findings, self.profiles, self.unsupported)

    @cached_property
    def stats(self) -> DataFrame:
        rules = self.rules if self.rules is not None else shipped_rules(self.files.sparkSession)
        applied = rules_applied(self.profiles, rules)
        if self.policy or self.written or not one_pass(self.patterns, self.detectors):
            return scan_stats(self.kept, self.skipped, self.findings, applied)
        analyzed = FP.analyze(self.kept, self.patterns, tuple(d.name for d in self.detectors), self.keep)
        return _stats_of(applied, FP.counts_of(analyzed), self.skipped)

    def export(self, path: str, started_at=None, part_size: int = RP.PART_SIZE) -> "Scan":
        """Store findings and errors in `path`, then write the records of all projects from them to `path`/records."""
        self.errors.write.mode("overwrite").parquet(f"{path}/errors")
        self.errors = self.files.sparkSession.read.parquet(f"{path}/errors")
        self.write(f"{path}/findings")
        parts = RC.record_parts(self.findings, self.errors, self.stats, self.profiles.select("project_id"), started_at, part_size)
        RC.write_records(parts, f"{path}/records")
        return self

    def write(self, path: str) -> "Scan":
        self.findings.write.mode("overwrite").parquet(path)
        for name in ("summary", "stats"):
            self.__dict__.pop(name, None)
        self.findings = self.files.sparkSession.read.parquet(path)
        self.written = True
        return self


def scan(files: DataFrame, **how) -> Scan:
    return Scan(files, **how)


def scan_directory(spark: SparkSession, root: str, project_depth: int = 0, pruned: bool = False, **how) -> Scan:
    """Scan a tree of repositories. Profiles, size errors and the choice of files come from the file list; only
    files that are analyzed are opened.

    `pruned`: directories that no scan looks at (`node_modules`, `venv`, ...) are not even listed. Their files then
    count neither for the languages of a project nor in `accounting`.
    """
    listing = TR.read_tree(spark, root, project_depth, vocab.EXCLUDED_PARTS if pruned else [])
    return Scan(listing, opener=lambda rows: TR.open_files(rows, root, project_depth), **how)
