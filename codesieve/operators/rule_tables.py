"""Rule tables of any size: one automaton over the anchors of all patterns instead of a plan that grows with them.

Spark checks the patterns and derives their anchors (words of which every match has one) as a table. The anchors of up
to PART_BYTES of that table become one automaton, which is broadcast; a pass over a line then names the patterns that can
match at all, and only those meet the line with their regular expression. A larger table is dealt by rule into parts of about
that size, each with a pass of its own, so what a task holds is bounded whatever the table. Patterns without a certain word are tried
on every line.

Expressions run in Python's own dialect, so every pattern that compiles is usable.

`table_findings` is for tables in which many rules share their patterns: rules with the same patterns and fields are one group, an expression
is checked, filed and searched once for all of them, and the hits of a group are joined with its rules afterwards. So tasks
and the driver hold distinct expressions, not rules, and a line is not met by every rule.
"""

import re
from collections.abc import Iterable
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from codesieve.functions import regex as R
from codesieve.functions import scoring as S
from codesieve.functions import text as X
from codesieve.functions.arrays import computed
from codesieve.functions.sizes import broadcast_if_small
from codesieve.operators import findings as FD
from codesieve.operators.lines import explode_lines
from codesieve.schemas import CANDIDATES, INT, TEXT, struct

PART_BYTES = 32 * 1024 * 1024
# What a pattern takes beside its text: its place, its compiled form.
PATTERN_BYTES = 1024
# The four letters that case-insensitive matching ties to ASCII ones.
FOLDS = str.maketrans("ſKİı", "skii")
# Rules that are joined to the hits of their group: this many in a row of the broadcast, which may have this size.
MEMBERS, MEMBER_ROWS, MEMBER_BYTES = 1000, 1_000_000, 256 * 1024 * 1024
GROUP_HITS = T.ArrayType(struct(group_ord=INT, pattern_ord=INT, column=INT))
CHECKED = T.StructType([T.StructField("error", T.StringType()), T.StructField("words", T.ArrayType(T.StringType()))])
_ARROW_CHECKED = to_arrow_type(CHECKED)
_ARROW_CANDIDATES = to_arrow_type(CANDIDATES)


@dataclass(frozen=True)
class TablePattern:
    phase: int
    rule_ord: int
    pattern_ord: int
    rule_id: str
    text: str
    flags: int
    languages: tuple
    severity: str
    message: str
    category: str
    confidence: float | None
    words: tuple


@dataclass
class Matcher:
    """First pattern in list order of every rule that hits a line."""

    patterns: list[TablePattern]
    always: list[int] = field(default_factory=list)
    owners: list[list[int]] = field(default_factory=list)
    automaton: ahocorasick.Automaton | None = None

    def __post_init__(self):
        self.patterns = sorted(self.patterns, key=lambda p: (p.phase, p.rule_ord, p.pattern_ord))
        self.compiled: dict[int, re.Pattern] = {}
        words: dict[str, list[int]] = {}
        for i, p in enumerate(self.patterns):
            for w in p.words:
                words.setdefault(w, []).append(i)
        self.always = [i for i, p in enumerate(self.patterns) if not p.words]
        self.owners = list(words.values())
        if words:
            self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
            for i, w in enumerate(words):
                self.automaton.add_word(w, i)
            self.automaton.make_automaton()

    def __getstate__(self):
        return {**self.__dict__, "compiled": {}}

    def candidates(self, line: str) -> list[int]:
        """Patterns that may match the line, in the order of rules and patterns."""
        if self.automaton is None:
            return self.always
        words = {w for _, w in self.automaton.iter(line.translate(FOLDS).lower())}
        if not words:
            return self.always
        return sorted({i for w in words for i in self.owners[w]}.union(self.always))

    def first_hits(self, line: str, language: str | None) -> Iterable[tuple[TablePattern, int]]:
        done = None
        for i in self.candidates(line):
            p = self.patterns[i]
            if (p.phase, p.rule_ord) == done or (p.languages and language not in p.languages):
                continue
            if i not in self.compiled:
                self.compiled[i] = re.compile(p.text, p.flags)
            if found := self.compiled[i].search(line):
                done = (p.phase, p.rule_ord)
                yield p, found.start() + 1


@dataclass(frozen=True)
class TablePart:
    """A broadcast matcher, where a literal pattern could stand in a list of patterns."""

    matcher: Broadcast

    def hits(self, lines: Column, language: Column) -> Column:
        """array<CANDIDATE> of the first hits of every rule on every line, from an array of lines."""
        shared = self.matcher

        @F.arrow_udf(CANDIDATES)
        def match(texts: pa.Array, languages: pa.Array) -> pa.Array:
            matcher = shared.value
            out = []
            for text, language in zip(texts, languages.to_pylist(), strict=True):
                out.append([
                    {
                        "line_number": n, "rule_id": p.rule_id, "phase": p.phase, "rule_ord": p.rule_ord, "pattern_ord": p.pattern_ord,
                        "match_ord": 0, "column": column, "severity": p.severity, "message": p.message, "category": p.category,
                        "confidence": p.confidence, "has_line": True,
                    }
                    for n, line in enumerate(text.as_py() or (), 1)
                    for p, column in matcher.first_hits(line, language)
                ])
            return pa.array(out, _ARROW_CANDIDATES)

        return match(lines, language)


@dataclass
class GroupMatcher:
    """Of every group of rules the first pattern that hits a line. An expression that groups share is searched once."""

    groups: list[tuple[int, tuple, list[tuple[int, str, int]]]]  # number, languages, (place, expression, flags)
    words: dict[str, tuple]  # of the usable expressions

    def __post_init__(self):
        places: dict[tuple[str, int], int] = {}
        self.owners: list[list[tuple[int, int, tuple]]] = []
        for number, languages, patterns in self.groups:
            for pattern_ord, text, flags in patterns:
                if text in self.words:
                    place = places.setdefault((text, flags), len(places))
                    if place == len(self.owners):
                        self.owners.append([])
                    self.owners[place].append((number, pattern_ord, languages))
        self.expressions, self.compiled, self.owners_of = list(places), {}, {}
        filed: dict[str, list[int]] = {}
        for (text, _), place in places.items():
            for w in self.words[text]:
                filed.setdefault(w, []).append(place)
        self.always = [place for (text, _), place in places.items() if not self.words[text]]
        self.filed, self.automaton = list(filed.values()), None
        if filed:
            self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
            for i, w in enumerate(filed):
                self.automaton.add_word(w, i)
            self.automaton.make_automaton()
        self.groups, self.words = [], {}

    def __getstate__(self):
        return {**self.__dict__, "compiled": {}, "owners_of": {}}

    def _owners(self, place: int, language: str | None) -> list[tuple[int, int]]:
        key = (place, language)
        if key not in self.owners_of:
            self.owners_of[key] = [(g, n) for g, n, languages in self.owners[place] if not languages or language in languages]
        return self.owners_of[key]

    def first_hits(self, line: str, language: str | None) -> dict[int, tuple[int, int]]:
        """{group: (place of the pattern, column)}"""
        places = set(self.always)
        if self.automaton is not None:
            for word in {w for _, w in self.automaton.iter(line.translate(FOLDS).lower())}:
                places.update(self.filed[word])
        best: dict[int, tuple[int, int]] = {}
        for place in places:
            owners = self._owners(place, language)
            if not owners:
                continue
            if place not in self.compiled:
                self.compiled[place] = re.compile(*self.expressions[place])
            if found := self.compiled[place].search(line):
                column = found.start() + 1
                for group, pattern_ord in owners:
                    if group not in best or pattern_ord < best[group][0]:
                        best[group] = (pattern_ord, column)
        return best


def _group_hits(shared: Broadcast, line: Column, language: Column) -> Column:
    arrow_type = to_arrow_type(GROUP_HITS)

    @F.arrow_udf(GROUP_HITS)
    def match(lines: pa.Array, languages: pa.Array) -> pa.Array:
        matcher, offsets, columns = shared.value, [0], ([], [], [])
        for text, own in zip(lines.to_pylist(), languages.to_pylist(), strict=True):
            for group, (pattern_ord, column) in matcher.first_hits(text, own).items() if text is not None else ():
                for values, value in zip(columns, (group, pattern_ord, column)):
                    values.append(value)
            offsets.append(len(columns[0]))
        rows = pa.StructArray.from_arrays([pa.array(c, pa.int32()) for c in columns], fields=list(arrow_type.value_type))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows).cast(arrow_type)

    return match(line, language)


def _flags() -> Column:
    cased = F.when(F.coalesce("case_sensitive", F.lit(False)), 0).otherwise(int(re.I))
    return cased.bitwiseOR(F.when(F.coalesce("multiline", F.lit(False)), int(re.M)).otherwise(0))


GROUP = ["patterns", "flags", "languages", "severity", "message", "category", "confidence"]


def rule_groups(rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(groups: group_ord and the columns GROUP; members: group_ord, rule_id, rule_ord, in_more) of the regex rules.

    `group_ord` is the smallest number of its rules; `in_more` tells that rules of several groups have the id.
    """
    rows = rules.where("rule_type = 'regex' and size(patterns) > 0").select(
        F.col("load_ord").cast("int").alias("rule_ord"), F.col("id").alias("rule_id"), "patterns", _flags().alias("flags"),
        F.coalesce(F.array_sort("target_languages"), F.array().cast("array<string>")).alias("languages"), "severity", F.col("description").alias("message"),
        "category", F.col("confidence_threshold").alias("confidence"),
    )
    groups = rows.groupBy(*GROUP).agg(F.min("rule_ord").alias("group_ord"))
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"g.{c}")) for c in GROUP]
    key = F.md5(F.to_json(F.struct(*GROUP), {"ignoreNullFields": "false"}).cast("binary"))
    members = rows.withColumn("k", key).alias("r").join(groups.withColumn("k", key).alias("g"), [F.col("r.k") == F.col("g.k"), *same])
    members = members.groupBy("g.group_ord", "r.rule_id").agg(F.min("r.rule_ord").alias("rule_ord"))
    many = members.groupBy("rule_id").agg((F.count("*") > 1).alias("in_more"))
    return groups, members.join(many, "rule_id")


def group_matchers(groups: DataFrame, part_bytes: int = PART_BYTES) -> list[Broadcast]:
    """Broadcast matchers of all groups, each of about part_bytes of distinct expressions."""

    @F.arrow_udf(CHECKED)
    def check(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts.to_pylist():
            error = R.pattern_error(text)
            out.append({"error": error, "words": [] if error else list(R.anchors(text))})
        return pa.array(out, _ARROW_CHECKED)

    context, parts = groups.sparkSession.sparkContext, []
    distinct = groups.select("flags", F.explode("patterns").alias("text")).distinct()
    size = distinct.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + PATTERN_BYTES)).first()[0] or 0
    n_parts = -(-size // part_bytes)
    for i in range(n_parts):
        # Groups of the same patterns are together.
        mine = groups.where(F.pmod(F.hash("patterns"), F.lit(n_parts)) == i)
        texts = mine.select(F.explode("patterns").alias("text")).distinct().repartition(context.defaultParallelism, "text")
        usable = texts.withColumn("checked", check("text")).where("checked.error is null").select("text", "checked.words").toArrow().to_pylist()
        rows = mine.select("group_ord", "languages", "patterns", "flags").toArrow().to_pylist()
        own = [(r["group_ord"], tuple(r["languages"]), [(n, text, r["flags"]) for n, text in enumerate(r["patterns"])]) for r in rows]
        if usable and own:
            parts.append(context.broadcast(GroupMatcher(own, {r["text"]: tuple(r["words"]) for r in usable})))
    return parts


def table_findings(files: DataFrame, rules: DataFrame, phase: int, keep: str = "first", part_bytes: int = PART_BYTES) -> DataFrame:
    """De-duplicated findings of the rules of a table in `files` (with their language): the first hit per line and rule id.

    Hits are of groups until the last step, so that only the result grows with the rules that share a pattern. Only ids that rules
    of different groups have are compared once more, by a shuffle.
    """
    groups, members = rule_groups(rules)
    lines = explode_lines(files, "project_id", "path", "language")
    none = F.array().cast(GROUP_HITS)
    found = [_group_hits(part, F.col("line"), F.col("language")) for part in group_matchers(groups, part_bytes)]
    for i, hits in enumerate(found):
        lines = lines.withColumn(f"part{i}", hits)
    lines = lines.withColumn("hits", F.concat(none, *[f"part{i}" for i in range(len(found))]))
    hits = lines.select("project_id", F.col("path").alias("file_path"), "line_number", X.strip(F.col("line")).alias("code_snippet"), F.explode(computed("hits")).alias("h"))
    hits = hits.select("project_id", "file_path", "line_number", "code_snippet", "h.*")
    sizes = members.groupBy("group_ord").agg((1 + F.floor(F.count("*") / MEMBERS)).alias("n"))
    packed = members.join(sizes, "group_ord").groupBy("group_ord", F.pmod(F.xxhash64("rule_id"), F.col("n")).alias("_pack"), "in_more").agg(F.collect_list(F.struct("rule_id", "rule_ord")).alias("rules"))
    packed = packed.drop("_pack").join(groups.drop("patterns", "flags", "languages"), "group_ord")
    small = broadcast_if_small(packed, MEMBER_ROWS, MEMBER_BYTES)
    packed = packed if small is None else small

    def of(members: DataFrame) -> DataFrame:
        rows = hits.join(members, "group_ord").withColumn("r", F.explode("rules"))
        return rows.select(
            "project_id", "file_path", "line_number", "column", "r.rule_id", "severity", "message", "category", F.lit(None).cast("string").alias("cwe_id"), "code_snippet", "confidence",
            F.lit(phase).alias("phase"), "r.rule_ord", "pattern_ord", F.lit(0).alias("match_ord"),
        )

    repeated = packed.where("in_more")
    if repeated.isEmpty():
        return of(packed).drop(*FD.FINDING_ORDER)
    return of(packed.where("not in_more")).drop(*FD.FINDING_ORDER).unionByName(FD.dedup(of(repeated), keep))


def _patterns(rules: DataFrame) -> DataFrame:
    """One row per pattern of the regex rules, unchecked."""
    return rules.where("rule_type = 'regex'").select("*", F.posexplode("patterns").alias("pattern_ord", "pattern"))


def pattern_table(rules: DataFrame) -> DataFrame:
    """One row per pattern of the regex rules, with its anchors, or the error for which it is left out.

    Checking a pattern costs far more than its size tells, so the rows are spread over the cores.
    """

    @F.arrow_udf(CHECKED)
    def check(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts.to_pylist():
            error = R.pattern_error(text)
            out.append({"error": error, "words": [] if error else list(R.anchors(text))})
        return pa.array(out, _ARROW_CHECKED)

    rows = _patterns(rules).repartition(rules.sparkSession.sparkContext.defaultParallelism)
    return rows.withColumn("checked", check("pattern")).select(
        F.col("load_ord").cast("int").alias("rule_ord"), "pattern_ord", F.col("id").alias("rule_id"), F.col("pattern").alias("text"),
        F.when(F.coalesce("case_sensitive", F.lit(False)), 0).otherwise(int(re.I)).bitwiseOR(F.when(F.coalesce("multiline", F.lit(False)), int(re.M)).otherwise(0)).alias("flags"),
        F.coalesce("target_languages", F.array().cast("array<string>")).alias("languages"), "severity", F.col("description").alias("message"), "category",
        F.col("confidence_threshold").alias("confidence"), "checked.words", "checked.error",
    )


def table_parts(rules: DataFrame, phase: int, part_bytes: int = PART_BYTES) -> list[TablePart]:
    """Broadcast matchers of all usable patterns, each of about part_bytes of rules at most."""
    own = F.struct("id", "pattern", "target_languages", "severity", "description", "category")
    size = _patterns(rules).agg(F.sum(F.octet_length(F.to_json(own)) + PATTERN_BYTES)).first()[0] or 0
    patterns = pattern_table(rules).where("error is null").drop("error")
    n_parts = -(-size // part_bytes)
    context = rules.sparkSession.sparkContext
    parts = []
    for i in range(n_parts):
        mine = patterns.where(F.pmod(F.hash("rule_ord"), F.lit(n_parts)) == i).toArrow().to_pylist()
        if mine:
            own = [TablePattern(phase=phase, **{**r, "languages": tuple(r["languages"]), "words": tuple(r["words"])}) for r in mine]
            parts.append(TablePart(context.broadcast(Matcher(own))))
    return parts


def severity_ranked(candidate: Column, keep: str) -> Column:
    """What decides between findings of one line and rule before the order of detection."""
    return S.severity_rank(candidate["severity"]) if keep == "max_severity" else F.lit(0)
