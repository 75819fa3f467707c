"""File inventory: language, inclusion, exclusion, size guard, project detection and counts."""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codesieve import vocab
from codesieve.functions import paths as P
from codesieve.functions import text as X
from codesieve.functions.literals import literal_array, literal_map, literal_map_of_arrays

def _path() -> Column:
    return F.col("path")


def with_language(files: DataFrame) -> DataFrame:
    return files.withColumn("language", P.language(_path()))


def files_of_language(files: DataFrame, name: str) -> DataFrame:
    return with_language(files).where(F.col("language") == name)


def default_excluded(path: Column) -> Column:
    return F.arrays_overlap(F.split(path, "/"), literal_array(vocab.EXCLUDED_PARTS))


def custom_excluded(path: Column, names: Column, mode: str = "substring") -> Column:
    """Whether one of the names is inside the path ('segment': is one of its parts)."""
    if mode == "segment":
        return F.arrays_overlap(F.split(path, "/"), names)
    # One regex of quoted names. A lambda over `names` that also reads `path` would be a join
    # condition the optimizer may push to the side that lacks `path`.
    quoted = F.transform(names, lambda n: F.regexp_replace(n, r"(\W)", r"\\$1"))
    return (F.size(names) > 0) & F.rlike(path, F.array_join(quoted, "|"))


def matches_global_exclusions(path: Column) -> Column:
    """The configured (never applied by default) name patterns and suffixes."""
    by_suffix = F.lit(False)
    for suffix in vocab.EXCLUDED_SUFFIXES:
        by_suffix = by_suffix | F.endswith(path, F.lit(suffix))
    return P.any_glob(path, vocab.EXCLUDED_FILE_PATTERNS) | by_suffix


def within_depth(path: Column, max_depth) -> Column:
    return P.depth(path) <= max_depth


def language_exclusions(primary: Column) -> Column:
    """Extra excluded names that come with a project's primary language."""
    table = literal_map_of_arrays(vocab.EXCLUDED_BY_LANGUAGE)
    return F.coalesce(F.try_element_at(table, primary), F.array().cast("array<string>"))


def excluded_by_language(path: Column, primary: Column, mode: str = "substring") -> Column:
    """The same test for the names that come with the primary language, as plain comparisons."""
    hit = F.lit(False)
    for lang, names in vocab.EXCLUDED_BY_LANGUAGE.items():
        if mode == "segment":
            inside = F.arrays_overlap(F.split(path, "/"), literal_array(names))
        else:
            inside = F.rlike(path, F.lit("|".join(re.escape(n) for n in names)))
        hit = hit | ((primary == lang) & inside)
    return hit


def included(
    path: Column,
    targets: Column,
    exclusion: Column,
    extensions: list[str] | Column | None = None,
) -> Column:
    """Include predicate: extension, not excluded, and a target language if any is set.

    `exclusion` is the condition that comes on top of the default excluded names.
    """
    if extensions is None:
        extensions = vocab.INCLUDED_EXTENSIONS
    by_extension = (
        P.extension(path).isin(*extensions)
        if isinstance(extensions, list)
        else F.array_contains(extensions, P.extension(path))
    )
    wanted = (F.size(targets) == 0) | F.array_contains(targets, P.language(path))
    kept = ~(default_excluded(path) | F.coalesce(exclusion, F.lit(False)))
    return by_extension & kept & F.coalesce(wanted, F.lit(True))


def split_by_size(files: DataFrame, max_bytes: Column) -> tuple[DataFrame, DataFrame]:
    """Files within the limit, and one error row per file over it or of unknown size."""
    size = F.col("size_bytes")
    too_big = F.coalesce(size > max_bytes, F.lit(True))
    oversize = F.format_string(vocab.MSG_OVERSIZE, size)
    errors = files.where(too_big).select(
        "project_id",
        "path",
        F.when(size.isNull(), "unreadable").otherwise("file_too_large").alias("reason"),
        F.concat("path", F.lit(": "), F.when(size.isNull(), "no size").otherwise(oversize)).alias("message"),
    )
    return files.where(~too_big), errors


def is_code_file(path: Column) -> Column:
    return _code_language(path).isNotNull()


def valid_projects(files: DataFrame) -> DataFrame:
    return files.groupBy("project_id").agg(F.bool_or(is_code_file(_path())).alias("valid"))


# --- project detection ------------------------------------------------------------

_LANGUAGE_ORD = {lang: i for i, lang in enumerate(vocab.INDICATORS)}
_BY_CODE_EXTENSION = {ext: vocab.EXTENSION_LANGUAGE[ext] for ext in vocab.CODE_EXTENSIONS}


def _indicator_hits(path: Column) -> Column:
    """Array of (language, points): what one file says about its project.

    Exact names count only at the top of the project, glob names at every depth.
    """
    exact: dict[str, list[str]] = {}
    globs: list[tuple[str, str]] = []
    for lang, names in vocab.INDICATORS.items():
        for indicator in names:
            if "*" in indicator:
                globs.append((indicator.replace("*", ""), lang))
            else:
                exact.setdefault(indicator, []).append(lang)
    top = F.when(~F.contains(path, F.lit("/")), P.file_name(path))
    languages = F.coalesce(
        F.try_element_at(literal_map_of_arrays(exact), top), F.array().cast("array<string>")
    )
    by_name = F.transform(
        languages,
        lambda lang: F.struct(
            lang.alias("language"), F.lit(vocab.INDICATOR_POINTS).alias("points")
        ),
    )
    by_glob = [
        F.when(
            F.endswith(path, F.lit(end)),
            F.struct(
                F.lit(lang).alias("language"), F.lit(vocab.GLOB_INDICATOR_POINTS).alias("points")
            ),
        )
        for end, lang in globs
    ]
    return F.concat(by_name, F.array_compact(F.array(*by_glob)))


def _code_language(path: Column) -> Column:
    """Language of one of the counted code extensions, else null."""
    case = None
    for ext, lang in _BY_CODE_EXTENSION.items():
        test = F.endswith(path, F.lit(ext))
        case = F.when(test, lang) if case is None else case.when(test, lang)
    return case


def language_evidence(files: DataFrame) -> DataFrame:
    """Per project and language: indicator points and code-file count. One shuffle of
    partial sums, at most a dozen rows per project and map task. Projects without any
    evidence keep one row with a null language."""
    indicator = F.transform(
        _indicator_hits(_path()),
        lambda h: F.struct(
            h["language"].alias("language"), h["points"].alias("points"), F.lit(0).alias("n")
        ),
    )
    code_language = _code_language(_path())
    code = F.when(
        code_language.isNotNull(),
        F.array(
            F.struct(
                code_language.alias("language"), F.lit(0).alias("points"), F.lit(1).alias("n")
            )
        ),
    ).otherwise(F.array().cast("array<struct<language:string,points:int,n:int>>"))
    return (
        files.select("project_id", F.explode_outer(F.concat(indicator, code)).alias("e"))
        .groupBy("project_id", F.col("e.language").alias("language"))
        .agg(F.sum("e.points").alias("points"), F.sum("e.n").alias("n_files"))
    )


def indicator_scores(files: DataFrame) -> DataFrame:
    return language_evidence(files).where("points > 0").select("project_id", "language", "points")


def extension_counts(files: DataFrame) -> DataFrame:
    return language_evidence(files).where("n_files > 0").select("project_id", "language", "n_files")


def detect_languages(files: DataFrame) -> DataFrame:
    """Primary language by indicators (else by code files) and the set of target languages."""
    order = F.try_element_at(literal_map(_LANGUAGE_ORD), F.col("language"))
    best = F.max(F.when(F.col("points") > 0, F.struct("points", -order, "language")))
    most = F.max(F.when(F.col("n_files") > 0, F.struct("n_files", -order, "language")))
    unknown = F.lit(vocab.UNKNOWN_LANGUAGE)
    found = F.array_sort(F.collect_set("language"))
    return (
        language_evidence(files)
        .groupBy("project_id")
        .agg(
            F.coalesce(best["language"], most["language"], unknown).alias("primary_language"),
            found.alias("found"),
        )
        .select(
            "project_id",
            "primary_language",
            F.when(F.size("found") > 0, F.col("found"))
            .otherwise(F.array(unknown))
            .alias("target_languages"),
        )
    )


def declared_names(files: DataFrame) -> DataFrame:
    """Names that package.json or setup.py declare, for projects that have one."""
    roots = files.where(_path().isin("package.json", "setup.py")).select(
        "project_id", "path", X.decode_text(F.col("content")).alias("text")
    )
    setup = F.regexp_extract("text", "name[\\s\\x1c-\\x1f]*=[\\s\\x1c-\\x1f]*[\"']([^\"']+)[\"']", 1)
    in_package = F.when(F.col("path") == "package.json", F.get_json_object("text", "$.name"))
    in_setup = F.when(F.col("path") == "setup.py", F.nullif(setup, F.lit("")))
    return roots.groupBy("project_id").agg(
        F.coalesce(F.max(in_package), F.max(in_setup)).alias("declared")
    )


def _with_name(projects: DataFrame, files: DataFrame) -> DataFrame:
    """Declared name, else the last part of the project's directory."""
    name = F.coalesce("declared", P.file_name(F.col("project_id")))
    return (
        projects.join(declared_names(files), "project_id", "left")
        .withColumn("name", name)
        .drop("declared")
    )


def project_names(files: DataFrame) -> DataFrame:
    return _with_name(files.select("project_id").distinct(), files)


def project_info(files: DataFrame) -> DataFrame:
    """One row per project: validity, name, languages and size over all its files."""
    base = files.groupBy("project_id").agg(
        F.bool_or(is_code_file(_path())).alias("valid"),
        (F.sum("size_bytes") / (1024 * 1024)).alias("size_mb"),
    )
    return _with_name(base.join(detect_languages(files), "project_id"), files).select(
        "project_id", "valid", "name", "primary_language", "target_languages", "size_mb"
    )


def project_sizes(files: DataFrame) -> DataFrame:
    return files.groupBy("project_id").agg((F.sum("size_bytes") / (1024 * 1024)).alias("size_mb"))


# --- counts over discovered files ---------------------------------------------------


def project_language_stats(files: DataFrame) -> DataFrame:
    """Files, lines and bytes per project and language, and (language null) per project."""
    counted = (
        with_language(files)
        .withColumn("text", X.decode_text(F.col("content")))
        .select("project_id", "language", "size_bytes", X.count_newlines(F.col("text")).alias("n"))
    )
    return counted.rollup("project_id", "language").agg(
        F.count("*").alias("total_files"),
        F.sum("n").alias("total_lines"),
        F.sum("size_bytes").alias("total_size_bytes"),
    ).where("project_id is not null")


def project_stats(files: DataFrame) -> DataFrame:
    """One row per project with a map of file counts per language.

    The map is built from one pre-aggregated row per language, so it stays small.
    """
    per_language = (
        with_language(files)
        .withColumn("text", X.decode_text(F.col("content")))
        .groupBy("project_id", "language")
        .agg(
            F.count("*").alias("f"),
            F.sum(X.count_newlines(F.col("text"))).alias("l"),
            F.sum("size_bytes").alias("b"),
        )
    )
    return per_language.groupBy("project_id").agg(
        F.sum("f").alias("total_files"),
        F.sum("l").alias("total_lines"),
        F.sum("b").alias("total_size_bytes"),
        F.map_from_entries(F.collect_list(F.struct("language", "f"))).alias("languages"),
    )


def filecount_language(files: DataFrame) -> DataFrame:
    """Language of most files; equal counts go to the first name in the alphabet."""
    counts = with_language(files).groupBy("project_id", "language").agg(F.count("*").alias("n"))
    return counts.groupBy("project_id").agg(
        F.min_by("language", F.struct(-F.col("n"), "language")).alias("primary_language")
    )
