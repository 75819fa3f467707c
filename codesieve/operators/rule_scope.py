"""Scope of rule tables of any size: which rules look at which files, without a plan that grows with the rules.

Rules with the same languages, globs and excluded paths share a scope, so each distinct scope is tested once per file. Scopes become
an index in broadcast parts of about PART_BYTES: a glob is filed under its literal beginning or end, whichever is longer, and a path
looks up its own ends and the beginnings of its parts, so only globs that can match meet it. Files then carry the ids of
their scopes, and the rules of a scope are joined to them (from a broadcast if their measured size allows it).

`rules_for_files` has a row per file and rule, which grows with both. `rule_totals` counts and sums the rules of a file without listing
them, by joins alone: a rule stands under each of its globs once, with those before it that must not match as well (commonest first, so
that rules which share a glob share a row), and is taken off again in the same way under its excluded paths.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codesieve.functions.paths import glob_regex
from codesieve.functions.sizes import broadcast_if_small

# Names that no glob, language or part of a path has.
ANY, NONE, NO_PATH = "\0any", "\0none", "\0path"
STEPS = "array<struct<name: string, before: array<string>>>"
PART_BYTES = 32 * 1024 * 1024
# What a scope takes beside its text.
SCOPE_BYTES = 1024
MEMBER_BYTES, MEMBER_ROWS = 64 * 1024 * 1024, 1_000_000
TESTS = ["target_languages", "file_patterns", "excluded_paths"]


def python_regex(glob: str) -> str:
    """The regex of `paths.any_glob` in Python's dialect."""
    return glob_regex(glob).removesuffix("\\z") + "\\Z"


def literal_ends(glob: str) -> tuple[str, str]:
    """What every match begins and ends with."""
    special = [i for i, ch in enumerate(glob) if ch in "*?[]"]
    return (glob[: special[0]], glob[special[-1] + 1 :]) if special else (glob, glob)


@dataclass
class ScopeIndex:
    """Scopes (id, languages, globs, excluded paths) by what a path must begin or end with."""

    scopes: list[tuple[str, tuple, tuple, tuple]]
    everywhere: list[int] = field(default_factory=list)
    heads: dict[str, list[tuple[int, str | None]]] = field(default_factory=dict)
    tails: dict[str, list[tuple[int, str | None]]] = field(default_factory=dict)

    def __post_init__(self):
        self.compiled: dict[str, re.Pattern] = {}
        for i, (_, _, globs, _) in enumerate(self.scopes):
            if not globs:
                self.everywhere.append(i)
            for glob in globs:
                head, tail = literal_ends(glob)
                table, key = (self.heads, head) if len(head) > len(tail) else (self.tails, tail)
                # `*` and an end inside one part of a path need no further test.
                table.setdefault(key, []).append((i, None if glob == "*" + tail and tail and "/" not in tail else glob))
        self.head_lengths, self.tail_lengths = ({len(k) for k in t} for t in (self.heads, self.tails))

    def __getstate__(self):
        return {**self.__dict__, "compiled": {}}

    def _candidates(self, path: str) -> Iterator[tuple[int, str | None]]:
        for n in self.tail_lengths:
            yield from self.tails.get(path[len(path) - n :] if n <= len(path) else None, ())
        if self.heads:
            for start in [0, *[m.end() for m in re.finditer("/", path)]]:
                for n in self.head_lengths:
                    yield from self.heads.get(path[start : start + n], ())

    def _matches(self, glob: str, path: str) -> bool:
        if glob not in self.compiled:
            self.compiled[glob] = re.compile(python_regex(glob))
        return self.compiled[glob].search(path) is not None

    def of(self, path: str | None, language: str | None) -> list[str]:
        """Ids of the scopes that a file is in, in their order. An unknown path or language is in no scope that asks for one."""
        found = set(self.everywhere)
        for i, glob in self._candidates(path) if path is not None else ():
            if i not in found and (glob is None or self._matches(glob, path)):
                found.add(i)
        kept = []
        for i in sorted(found):
            name, languages, _, excluded = self.scopes[i]
            if (not languages or language in languages) and not (excluded and (path is None or any(e in path for e in excluded))):
                kept.append(name)
        return kept


def scoped(rules: DataFrame, categories: list[str] | None = None) -> DataFrame:
    """(scope, rule_id, load_ord, target_languages, file_patterns, excluded_paths) of rules in use."""
    used = rules.where("enabled")
    if categories is not None:
        used = used.where(F.col("category").isin(*categories))
    none = F.array().cast("array<string>")
    tests = {n: F.coalesce(F.array_sort(F.array_distinct(F.array_compact(n))), none) if n in rules.columns else none for n in TESTS}
    used = used.select(F.col("id").alias("rule_id"), F.col("load_ord").cast("bigint").alias("load_ord"), *[c.alias(n) for n, c in tests.items()])
    return used.withColumn("scope", F.md5(F.to_json(F.struct(*TESTS)).cast("binary")))


def indexes(rows: DataFrame, part_bytes: int = PART_BYTES) -> list:
    """Broadcast indexes of all scopes of `scoped`, of about part_bytes each."""
    scopes = rows.groupBy("scope").agg(*[F.first(n).alias(n) for n in TESTS])
    size = scopes.agg(F.sum(F.octet_length(F.to_json(F.struct(*TESTS))) + SCOPE_BYTES)).first()[0] or 0
    n_parts, context, parts = -(-size // part_bytes), rows.sparkSession.sparkContext, []
    for i in range(n_parts):
        mine = scopes.where(F.pmod(F.hash("scope"), F.lit(n_parts)) == i).orderBy("scope").toArrow().to_pylist()
        if mine:
            parts.append(context.broadcast(ScopeIndex([(r["scope"], *[tuple(r[n]) for n in TESTS]) for r in mine])))
    return parts


def rules_for_files(files: DataFrame, rules: DataFrame, categories: list[str] | None = None, part_bytes: int = PART_BYTES) -> DataFrame:
    """`files` (with path and language), once per rule that looks at them, with rule_id and load_ord."""
    rows = scoped(rules, categories)

    def scopes_of(index):
        @F.arrow_udf("array<string>")
        def find(path: pa.Array, language: pa.Array) -> pa.Array:
            seen = zip(path.to_pylist(), language.to_pylist())
            return pa.array([index.value.of(p, x) for p, x in seen], pa.list_(pa.string()))

        return find("path", "language")

    found = [scopes_of(part) for part in indexes(rows, part_bytes)]
    none = F.array().cast("array<string>")
    hits = files.withColumn("_scopes", F.concat(none, *found)).select(*files.columns, F.explode("_scopes").alias("_scope"))
    members = rows.select(F.col("scope").alias("_scope"), "rule_id", "load_ord")
    small = broadcast_if_small(members, MEMBER_ROWS, MEMBER_BYTES)
    return hits.join(members if small is None else small, "_scope").drop("_scope")


def _commonest_first(scopes: DataFrame, tests: str) -> DataFrame:
    """(scope, list): the tests of each scope that has some, those of most rules first."""
    rows = scopes.select("scope", "n_rules", F.explode(tests).alias("test"))
    counts = rows.groupBy("test").agg(F.sum("n_rules").alias("n"))
    ordered = rows.join(counts, "test").groupBy("scope").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "test"))).alias("list"))
    return ordered.select("scope", F.col("list.test").alias("list"))


def _steps(tests: Column) -> Column:
    """A test with those before it, for each test of a list."""
    return F.transform(tests, lambda x, i: F.struct(x.alias("name"), F.slice(tests, 1, i).alias("before"))).cast(STEPS)


def _nodes(scopes: DataFrame) -> DataFrame:
    """(language, glob, globs_before, part, parts_before, n_rules, sum_ord): what a file adds up that has the first of each and none of those before."""
    none = F.array().cast("array<string>")
    rows = scopes
    for column, tests in (("globs", "file_patterns"), ("parts", "excluded_paths")):
        rows = rows.join(_commonest_first(scopes, tests).withColumnRenamed("list", column), "scope", "left")
    languages = F.when(F.size("target_languages") == 0, F.array(F.lit(ANY))).otherwise(F.col("target_languages"))
    globs = F.when(F.col("globs").isNull(), F.array(F.lit(ANY))).otherwise(F.col("globs"))
    kept = F.array(F.struct(F.lit(NONE).alias("name"), none.alias("before"))).cast(STEPS)
    # A file without path is in no scope that excludes something.
    gone = F.when(F.col("parts").isNotNull(), _steps(F.concat(F.array(F.lit(NO_PATH)), "parts"))).otherwise(F.array().cast(STEPS))
    rows = rows.select(F.explode(languages).alias("language"), _steps(globs).alias("globs"), F.concat(kept, gone).alias("parts"), "n_rules", "sum_ord")
    rows = rows.select("language", F.explode("globs").alias("g"), "parts", "n_rules", "sum_ord").select("language", "g", F.explode("parts").alias("p"), "n_rules", "sum_ord")
    sign = F.when(F.col("p.name") == NONE, 1).otherwise(-1)
    keys = [F.col("g.name").alias("glob"), F.col("g.before").alias("globs_before"), F.col("p.name").alias("part"), F.col("p.before").alias("parts_before")]
    return rows.groupBy("language", *keys).agg(F.sum(sign * F.col("n_rules")).alias("n_rules"), F.sum(sign * F.col("sum_ord")).alias("sum_ord"))


def _lengths(table: DataFrame, key: str) -> Column:
    return F.lit([r[0] for r in table.select(F.length(key).alias("n")).distinct().collect()]).cast("array<int>")


def _globs_of(paths: DataFrame, scopes: DataFrame) -> DataFrame:
    """(path, globs) of paths that match some: each glob is looked up by its literal end or beginning."""

    @F.arrow_udf("struct<is_head: boolean, key: string, regex: string>")
    def filed(globs: pa.Array) -> pa.Array:
        out = []
        for glob in globs.to_pylist():
            head, tail = literal_ends(glob)
            is_head = len(head) > len(tail)
            out.append({"is_head": is_head, "key": head if is_head else tail, "regex": glob_regex(glob)})
        return pa.array(out, pa.struct([("is_head", pa.bool_()), ("key", pa.string()), ("regex", pa.string())]))

    globs = scopes.select(F.explode("file_patterns").alias("glob")).distinct().withColumn("f", filed("glob")).select("glob", "f.*")
    path, length = F.col("path"), F.length("path")
    tails = F.transform(F.filter(_lengths(globs.where("not is_head"), "key"), lambda n: n <= length), lambda n: F.struct(F.lit(False).alias("is_head"), F.substring(path, length - n + 1, n).alias("key")))
    # Where a part of the path begins.
    starts = F.filter(F.sequence(F.lit(1), F.greatest(length, F.lit(1))), lambda i: (i == 1) | (F.substring(path, i - 1, F.lit(1)) == "/"))
    lengths = _lengths(globs.where("is_head"), "key")
    heads = F.flatten(F.transform(starts, lambda i: F.transform(F.filter(lengths, lambda n: i + n <= length + 1), lambda n: F.struct(F.lit(True).alias("is_head"), F.substring(path, i, n).alias("key")))))
    rows = paths.select("path", F.explode(F.array_distinct(F.concat(tails, heads))).alias("k")).select("path", "k.*")
    small = broadcast_if_small(globs, MEMBER_ROWS, MEMBER_BYTES)
    found = rows.join(globs if small is None else small, ["is_head", "key"]).where(F.rlike("path", F.col("regex")))
    return found.groupBy("path").agg(F.collect_set("glob").alias("globs"))


def _parts_of(paths: DataFrame, scopes: DataFrame) -> DataFrame:
    """(path, parts) of paths that contain excluded texts."""
    excluded = scopes.select(F.explode("excluded_paths").alias("part")).distinct()
    path, length = F.col("path"), F.length("path")
    within = F.transform(F.filter(_lengths(excluded, "part"), lambda n: n <= length), lambda n: F.transform(F.sequence(F.lit(1), length - n + 1), lambda i: F.substring(path, i, n)))
    rows = paths.select("path", F.explode(F.array_distinct(F.flatten(within))).alias("part"))
    small = broadcast_if_small(excluded, MEMBER_ROWS, MEMBER_BYTES)
    return rows.join(excluded if small is None else small, "part").groupBy("path").agg(F.collect_list("part").alias("parts"))


def rule_totals(files: DataFrame, rules: DataFrame, categories: list[str] | None = None) -> DataFrame:
    """`files` (with path and language) that some rule looks at, with n_rules and sum_ord, the number of these rules and the sum of their load_ord.

    The same as counting the rows of `rules_for_files`, by work that grows with files plus rules.
    """
    scopes = scoped(rules, categories).groupBy("scope").agg(*[F.first(n).alias(n) for n in TESTS], F.count("*").alias("n_rules"), F.coalesce(F.sum("load_ord"), F.lit(0)).alias("sum_ord"))
    paths = files.select("path").where("path is not null").distinct()
    none = F.array().cast("array<string>")
    places = files.select("path", "language").distinct()
    places = places.join(_globs_of(paths, scopes), "path", "left").join(_parts_of(paths, scopes), "path", "left")
    parts = F.when(F.col("path").isNull(), F.array(F.lit(NO_PATH))).otherwise(F.coalesce("parts", none))
    places = places.select(
        "path", "language", F.concat(F.array(F.lit(ANY)), F.coalesce("globs", none)).alias("globs"), F.concat(F.array(F.lit(NONE)), parts).alias("parts")
    )
    asked = places.select("path", F.col("language").alias("own"), "globs", "parts", F.explode(F.array_compact(F.array(F.lit(ANY), "language"))).alias("language"))
    asked = asked.select("*", F.explode("globs").alias("glob")).select("*", F.explode("parts").alias("part"))
    nodes = _nodes(scopes)
    small = broadcast_if_small(nodes, MEMBER_ROWS, MEMBER_BYTES)
    met = asked.join(nodes if small is None else small, ["language", "glob", "part"])
    met = met.where(~F.arrays_overlap("globs", "globs_before") & ~F.arrays_overlap("parts", "parts_before"))
    totals = met.groupBy(F.col("path").alias("_path"), F.col("own").alias("_own")).agg(F.sum("n_rules").alias("n_rules"), F.sum("sum_ord").alias("sum_ord")).where("n_rules > 0")
    same = F.col("path").eqNullSafe(F.col("_path")) & F.col("language").eqNullSafe(F.col("_own"))
    return files.join(totals, same).drop("_path", "_own")
