"""DuckDB statements that say in SQL what the queries of `queries.py` return."""

import json

from codesieve import packs, vocab
from codesieve.functions.text import BLANKS
from codesieve.plans.corpus import DIRECTORIES, LINES_PER_FILE, SETTINGS, SUFFIXES, with_corpus
from codesieve.plans.queries import ENABLED_CATEGORIES, SYLLABLES, USER_SETTINGS

ORACLES: dict[str, str] = {}


def q(text) -> str:
    if text is None:
        return "NULL"
    if isinstance(text, bool):
        return "TRUE" if text else "FALSE"
    if isinstance(text, (int, float)):
        return str(text)
    return "'" + text.replace("'", "''") + "'"


def values(rows, columns: str) -> str:
    body = ", ".join("(" + ", ".join(q(v) for v in row) + ")" for row in rows)
    return f"(VALUES {body}) AS v({columns})"


def any_of(column: str, names) -> str:
    return "(" + " OR ".join(f"contains({column}, {q(n)})" for n in names) + ")"


# --- inventory -----------------------------------------------------------------------------

EXT = values(list(vocab.EXTENSION_LANGUAGE.items()), "ext, language")
LANG_ORD = values([(k, i) for i, k in enumerate(vocab.INDICATORS)], "language, ord")

INVENTORY = f""",
named AS (
  SELECT *, regexp_extract(path, '[^/]*$') AS name,
         len(string_split(path, '/')) - 1 AS depth
  FROM afile
),
typed AS (
  SELECT n.*, lower(regexp_extract(name, '^.+(\\.[^.]+)$', 1)) AS suffix,
         coalesce(v.language, 'unknown') AS language
  FROM named n LEFT JOIN {EXT} ON v.ext = lower(regexp_extract(name, '^.+(\\.[^.]+)$', 1))
),
points AS (
  SELECT t.project_id, v.language, sum(CASE WHEN v.is_glob THEN {vocab.GLOB_INDICATOR_POINTS}
         ELSE {vocab.INDICATOR_POINTS} END) AS points
  FROM typed t JOIN {values(
      [(lang, n.replace("*", ""), "*" in n) for lang, ns in vocab.INDICATORS.items() for n in ns],
      "language, indicator, is_glob")}
    ON (v.is_glob AND ends_with(t.name, v.indicator))
    OR (NOT v.is_glob AND t.depth = 0 AND t.name = v.indicator)
  GROUP BY ALL
),
counted AS (
  SELECT t.project_id, v.language, count(*) AS n_files
  FROM typed t JOIN {values(
      [(vocab.EXTENSION_LANGUAGE[e], e) for e in vocab.CODE_EXTENSIONS], "language, ext")}
    ON ends_with(t.name, v.ext)
  GROUP BY ALL
),
evidence AS (
  SELECT project_id, language, points AS score, 1 AS kind FROM points
  UNION ALL SELECT project_id, language, n_files, 0 FROM counted
),
profile AS (
  SELECT p.project_id, coalesce(b.language, 'unknown') AS primary_language,
         coalesce(t.targets, ['unknown']) AS targets
  FROM (SELECT DISTINCT project_id FROM afile) p
  LEFT JOIN (SELECT e.project_id, e.language FROM evidence e JOIN {LANG_ORD} USING (language)
             QUALIFY row_number() OVER (PARTITION BY e.project_id
                                        ORDER BY e.kind DESC, e.score DESC, v.ord) = 1) b
    USING (project_id)
  LEFT JOIN (SELECT project_id, list_sort(list(DISTINCT language)) AS targets
             FROM evidence GROUP BY project_id) t USING (project_id)
),
custom AS (
  SELECT * FROM {values(
      [(k, n) for k, ns in vocab.EXCLUDED_BY_LANGUAGE.items() for n in ns], "language, part")}
),
flagged AS (
  SELECT t.*, p.primary_language, p.targets,
         len(list_intersect(string_split(t.path, '/'),
             [{", ".join(q(x) for x in vocab.EXCLUDED_PARTS)}])) > 0 AS by_default,
         EXISTS (SELECT 1 FROM custom c
                 WHERE c.language = p.primary_language AND contains(t.path, c.part)) AS by_language
  FROM typed t JOIN profile p USING (project_id)
),
included AS (
  SELECT * FROM flagged
  WHERE suffix IN ('.py', '.pyw') AND NOT by_default AND NOT by_language
    AND list_contains(targets, language) AND depth <= 10
),
included_js AS (
  SELECT * FROM flagged
  WHERE suffix IN ('.py', '.pyw', '.js') AND NOT by_default AND NOT by_language
    AND list_contains(targets, language) AND depth <= 10
)
"""


def newlines(text: str) -> str:
    return (
        f"CAST(length({text}) - length(replace({text}, chr(10), '')) + "
        f"CASE WHEN {text} <> '' AND right({text}, 1) <> chr(10) THEN 1 ELSE 0 END AS BIGINT)"
    )


ORACLES["line_index"] = with_corpus("SELECT project_id, path, line_number, line FROM cline")
ORACLES["line_counts"] = with_corpus(
    f"SELECT project_id, path, {newlines('text')} AS n_split_lines, {newlines('text')} AS n_newlines FROM afile"
)
ORACLES["document_line_counts"] = f"""
SELECT source AS project_id, 'docs/d' || doc_id || '.py' AS path,
       {newlines('text')} AS n_split_lines, {newlines('text')} AS n_newlines FROM documents"""
ORACLES["page_line_counts"] = f"""
SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS project_id, count(*) AS files,
       CAST(sum({newlines('html')}) AS BIGINT) AS lines,
       CAST(sum(octet_length(encode(html))) AS BIGINT) AS bytes
FROM pages GROUP BY 1"""
ORACLES["line_lookup"] = with_corpus(
    """SELECT project_id, path, line_number, line, trim(line) AS stripped FROM (
         SELECT project_id, path, line_number, line FROM cline
         QUALIFY line_number = max(line_number) OVER (PARTITION BY project_id, path)
         UNION ALL
         SELECT project_id, path, max(line_number) + 1, '' FROM cline GROUP BY project_id, path)"""
)
ORACLES["snippets"] = with_corpus(
    """SELECT h.project_id, h.path, h.line_number,
         string_agg((CASE WHEN l.line_number = h.line_number THEN '>>> ' ELSE '   ' END)
                    || lpad(CAST(l.line_number AS VARCHAR), 3, ' ') || ' ' || l.line,
                    chr(10) ORDER BY l.line_number) AS snippet
       FROM cline h JOIN cline l ON l.file_no = h.file_no
        AND l.line_number BETWEEN h.line_number - 2 AND h.line_number + 2
       WHERE contains(h.line, 'hashlib.md5')
       GROUP BY h.project_id, h.path, h.line_number"""
)


def inv(body: str, more: str = "") -> str:
    return with_corpus(body, INVENTORY + more)


ORACLES["lang_by_extension"] = inv("SELECT project_id, path, suffix AS ext, language FROM typed")
ORACLES["included_files"] = inv("SELECT project_id, path, language, size_bytes FROM included")
ORACLES["excluded_files"] = inv(
    "SELECT project_id, path, by_default, by_language FROM flagged WHERE by_default OR by_language"
)
ORACLES["custom_exclusions"] = inv(
    """SELECT project_id, path FROM included
       WHERE NOT (CAST(project_id[5] AS INTEGER) % 2 = 0
                  AND (contains(path, 'lib/a') OR contains(path, 'dev')))"""
)
ORACLES["tree_listing"] = inv("SELECT project_id, path, size_bytes FROM flagged WHERE NOT by_default")
ORACLES["depth_limited"] = inv("SELECT project_id, path, depth FROM typed WHERE depth <= 1")
ORACLES["oversize_errors"] = with_corpus(
    f"""SELECT project_id, path, 'file_too_large' AS reason,
          path || ': ' || replace({q(vocab.MSG_OVERSIZE)}, '%s', CAST(size_bytes AS VARCHAR)) AS message
        FROM afile WHERE size_bytes > 520"""
)
ORACLES["globally_excluded"] = """
SELECT page_id, path FROM (
  SELECT page_id, 'web/p' || page_id || ['.log', '.min.js', '.py', '.swp', '.map'][page_id % 5 + 1] AS path
  FROM pages)
WHERE path LIKE '%.log' OR path LIKE '%.min.js' OR path LIKE '%.swp' OR path LIKE '%.map'"""
ORACLES["files_of_python"] = inv(
    "SELECT project_id, path, size_bytes FROM typed WHERE language = 'python'"
)
ORACLES["indicator_scores"] = inv(
    "SELECT project_id, language, CAST(points AS BIGINT) AS points FROM points"
)
ORACLES["extension_counts"] = inv("SELECT project_id, language, n_files FROM counted")
ORACLES["primary_language_indicator"] = inv("SELECT project_id, primary_language FROM profile")
ORACLES["target_languages"] = inv(
    "SELECT project_id, array_to_string(targets, ',') AS target_languages FROM profile"
)
ORACLES["primary_language_filecount"] = inv(
    """SELECT project_id, language AS primary_language FROM (
         SELECT project_id, language, count(*) AS n FROM typed GROUP BY 1, 2)
       QUALIFY row_number() OVER (PARTITION BY project_id ORDER BY n DESC, language) = 1"""
)
VALID = "bool_or(" + " OR ".join(f"ends_with(name, {q(e)})" for e in vocab.CODE_EXTENSIONS) + ")"
ORACLES["valid_projects"] = inv(f"SELECT project_id, {VALID} AS valid FROM typed GROUP BY project_id")
NAMES = """,
pnames AS (
  SELECT p.project_id, coalesce(
    max(CASE WHEN t.path = 'package.json' AND json_valid(t.text)
             THEN json_extract_string(CASE WHEN json_valid(t.text) THEN t.text END, '$.name') END),
    max(CASE WHEN t.path = 'setup.py'
             THEN nullif(regexp_extract(t.text, 'name\\s*=\\s*["'']([^"'']+)["'']', 1), '') END),
    p.project_id) AS name
  FROM profile p JOIN typed t USING (project_id) GROUP BY p.project_id
)"""
ORACLES["project_names"] = inv("SELECT project_id, name FROM pnames", NAMES)
ORACLES["project_info"] = inv(
    f"""SELECT t.project_id, {VALID.replace('name', 't.name')} AS valid, any_value(n.name) AS name,
          any_value(p.primary_language) AS primary_language,
          array_to_string(any_value(p.targets), ',') AS target_languages,
          sum(t.size_bytes) / 1048576 AS size_mb
        FROM typed t JOIN profile p USING (project_id) JOIN pnames n USING (project_id)
        GROUP BY t.project_id""",
    NAMES,
)
ORACLES["project_stats"] = inv(
    f"""SELECT project_id, language, count(*) AS total_files,
          CAST(sum({newlines('text')}) AS BIGINT) AS total_lines,
          CAST(sum(size_bytes) AS BIGINT) AS total_size_bytes
        FROM typed GROUP BY GROUPING SETS ((project_id, language), (project_id))"""
)
ORACLES["project_stats_map"] = inv(
    """SELECT project_id, CAST(sum(n) AS BIGINT) AS total_files,
          CAST(sum(l) AS BIGINT) AS total_lines, CAST(sum(b) AS BIGINT) AS total_size_bytes,
          string_agg(language || '=' || n, ',' ORDER BY language || '=' || n) AS languages
        FROM (SELECT project_id, language, count(*) AS n, sum(%s) AS l, sum(size_bytes) AS b
              FROM typed GROUP BY 1, 2) GROUP BY project_id""" % newlines("text")
)


def _option(name: str, value: str) -> tuple[str, str]:
    low, high, _, unit, key = vocab.OPTION_BOUNDS[name]
    clamped = f"least(greatest(CAST({value} AS DOUBLE), {float(low)}), {float(high)}) AS {name}"
    warning = (
        f"CASE WHEN {value} < {low} THEN {q(vocab.MSG_OPTION_LOW % (key, low, unit))} "
        f"WHEN {value} > {high} THEN {q(vocab.MSG_OPTION_HIGH % (key, high, unit))} END"
    )
    return clamped, warning


_OPTIONS = [
    _option("max_file_size_mb", "coalesce(CASE WHEN size_bytes % 2 = 0 THEN size_bytes END, 10.0)"),
    _option("max_depth", "size_bytes % 40"),
    _option("timeout_seconds", "5"),
    _option("max_workers", "8"),
    _option("min_confidence", "coalesce(CASE WHEN size_bytes % 3 = 0 THEN 1.5 END, 0.7)"),
]
ORACLES["job_options"] = with_corpus(
    f"""SELECT project_id || '/' || path AS project_id, {", ".join(c for c, _ in _OPTIONS)},
          array_to_string([x for x in [{", ".join(w for _, w in _OPTIONS)}] if x IS NOT NULL], '; ')
            AS warnings
        FROM afile WHERE contains(path, '/')"""
)
ORACLES["detector_routing"] = inv(
    """SELECT project_id, path,
         CASE WHEN suffix IN ('.py', '.pyw') THEN 'python_syntax' END AS by_extension,
         CASE WHEN language = 'python' THEN 'python_syntax' END AS by_language FROM typed"""
)
ORACLES["unroutable_files"] = inv(
    "SELECT project_id, path FROM typed WHERE suffix NOT IN ('.py', '.pyw')"
)
ORACLES["manifest_roundtrip"] = inv(
    """SELECT p.project_id AS name, '/srv/' || p.project_id AS root_path,
         strftime(date_trunc('second', max(t.last_modified)), '%Y-%m-%dT%H:%M:%S') AS created_at,
         array_to_string(any_value(p.targets), ',') AS target_languages,
         coalesce(any_value(x.parts), '') AS excluded_paths
       FROM profile p JOIN typed t USING (project_id)
       LEFT JOIN (SELECT language, string_agg(part, ',' ORDER BY part) AS parts FROM custom GROUP BY 1) x
         ON x.language = p.primary_language
       GROUP BY p.project_id"""
)

# --- rules ------------------------------------------------------------------------------------

PART = f"""WITH prule AS (
  SELECT CASE WHEN p_size % 5 = 0 THEN 'R' || (p_partkey // 4) ELSE 'P' || p_partkey END AS id,
    p_name AS name, p_type AS description,
    [{", ".join(q(s) for s in vocab.SEVERITIES)}][p_size % 5 + 1] AS severity,
    [{", ".join(q(c) for c in vocab.CATEGORIES)}][p_partkey % 13 + 1] AS category,
    CASE WHEN p_size % 4 = 3 THEN 'ast' ELSE 'regex' END AS rule_type,
    CASE WHEN p_size % 11 = 0 THEN [] WHEN p_size % 13 = 0
         THEN [replace(p_name, ' ', '\\s+'), '(' || p_type]
         ELSE [replace(p_name, ' ', '\\s+')] END AS patterns,
    CASE p_partkey % 4 WHEN 0 THEN [] WHEN 1 THEN ['python'] WHEN 2 THEN ['python', 'javascript']
         ELSE ['java'] END AS target_languages,
    p_size % 3 <> 0 AS enabled,
    CASE WHEN NOT (p_brand = 'Brand#4' OR p_size % 6 = 0) THEN 'CWE-' || p_size END AS cwe_id,
    p_partkey AS load_ord
  FROM part
)
"""
ORACLES["rules_catalog"] = PART + """
SELECT 'category' AS dimension, category AS value, count(*) AS n FROM prule GROUP BY 2
UNION ALL SELECT 'severity', severity, count(*) FROM prule GROUP BY 2
UNION ALL SELECT 'language', l, count(*) FROM (SELECT unnest(target_languages) AS l FROM prule) GROUP BY 2"""
_COUNTS = "count(*) AS total, count(*) FILTER (enabled) AS enabled, count(*) FILTER (NOT enabled) AS disabled"
ORACLES["rules_stats"] = PART + f"""
SELECT 'all' AS dimension, 'all' AS value, {_COUNTS} FROM prule
UNION ALL SELECT 'category', category, {_COUNTS} FROM prule GROUP BY 2
UNION ALL SELECT 'severity', severity, {_COUNTS} FROM prule GROUP BY 2
UNION ALL SELECT 'rule_type', rule_type, {_COUNTS} FROM prule GROUP BY 2"""
ORACLES["rules_filtered"] = PART + """
SELECT id, load_ord, severity, category FROM prule
WHERE category LIKE '%in%' AND list_contains(target_languages, 'python')
  AND severity = 'HIGH' AND enabled"""
ISSUES = f""", issue AS (
  SELECT id, 'error' AS level, 'duplicate_id' AS issue,
         replace({q(vocab.MSG_DUPLICATE_ID)}, '%s', id) AS message
  FROM prule QUALIFY row_number() OVER (PARTITION BY id ORDER BY load_ord) > 1
  UNION ALL
  SELECT id, 'error', 'no_patterns', replace({q(vocab.MSG_NO_PATTERNS)}, '%s', id)
  FROM prule WHERE len(patterns) = 0
  UNION ALL
  SELECT id, 'warning', 'no_cwe', replace({q(vocab.MSG_NO_CWE)}, '%s', id)
  FROM prule WHERE cwe_id IS NULL
)"""
ORACLES["rules_issues"] = PART + ISSUES + " SELECT * FROM issue"
ORACLES["rules_validation"] = PART + ISSUES + """
SELECT (SELECT count(*) FROM prule) AS total_rules, (SELECT count(*) FROM prule) AS valid_rules,
       CAST(0 AS BIGINT) AS invalid_rules,
       count(*) FILTER (issue = 'duplicate_id') AS n_duplicates,
       count(*) FILTER (level = 'error') AS n_errors,
       count(*) FILTER (level = 'warning') AS n_warnings,
       count(DISTINCT id) FILTER (level = 'error') AS n_with_errors FROM issue"""
ORACLES["rules_duplicates"] = PART + """
SELECT id, count(*) AS n FROM prule GROUP BY id HAVING count(*) > 1"""
UPSERT = """
SELECT id, arg_max(name, load_ord) AS name, arg_max(severity, load_ord) AS severity,
       min(load_ord) AS load_ord FROM prule GROUP BY id"""
ORACLES["rules_upsert"] = PART + UPSERT
ORACLES["rules_combined"] = PART + """
, renumbered AS (
  SELECT id, name, category, CASE WHEN load_ord % 2 = 0 THEN load_ord ELSE load_ord +
    (SELECT max(load_ord) + 1 FROM prule WHERE load_ord % 2 = 0) END AS load_ord
  FROM prule
)
SELECT id, arg_max(name, load_ord) AS name, arg_max(category, load_ord) AS category,
       min(load_ord) AS load_ord
FROM renumbered WHERE id NOT IN (SELECT id FROM prule WHERE category = 'xss') GROUP BY id"""
ORACLES["rules_of_category"] = PART + """
SELECT id, name, load_ord FROM prule WHERE category = 'cryptography'"""
ORACLES["pattern_rejects"] = PART + """
SELECT id, 1 AS pattern_ord, patterns[2] AS pattern FROM prule
WHERE rule_type = 'regex' AND len(patterns) = 2"""
SCOPE = values(
    [
        (r["id"], ",".join(r["target_languages"]), "|".join(
            p.replace("*.", "") for p in r["file_patterns"]), ",".join(r["excluded_paths"]))
        for r in packs.SHIPPED_RULES
    ],
    "rule_id, langs, exts, parts",
)
ORACLES["rules_for_file"] = inv(
    f"""SELECT t.project_id, t.path, v.rule_id FROM typed t JOIN {SCOPE}
          ON list_contains(string_split(v.langs, ','), t.language)
         AND regexp_matches(t.name, '\\.(' || v.exts || ')$')
        WHERE NOT EXISTS (SELECT 1 FROM unnest(string_split(v.parts, ',')) AS u(part)
                          WHERE contains(t.path, u.part))"""
)
_IN_CATEGORIES = ", ".join(q(r["id"]) for r in packs.SHIPPED_RULES if r["category"] in ENABLED_CATEGORIES)
ORACLES["rules_for_file_of_category"] = f"SELECT * FROM ({ORACLES['rules_for_file']}) WHERE rule_id IN ({_IN_CATEGORIES})"
ORACLES["detector_catalogue"] = inv(
    """SELECT * FROM (VALUES ('line_patterns', '', '', '1.0.0', 0), ('python_syntax', 'python', '.py,.pyw', '1.0.0', 1)) d(name, languages, extensions, version, k)
       JOIN (SELECT count(*) FILTER (suffix IN ('.py', '.pyw')) AS c FROM typed) ON true""".replace("SELECT *", "SELECT name, languages, extensions, version, k * c AS n_files")
)
ORACLES["rule_table_scope"] = inv(
    """SELECT t.project_id, t.path, count(*) AS n_rules, sum(load_ord)::BIGINT AS sum_ord
       FROM typed t JOIN prule r ON r.enabled AND (len(r.target_languages) = 0 OR list_contains(r.target_languages, t.language))
        AND CASE load_ord % 5 WHEN 0 THEN true WHEN 1 THEN ends_with(t.name, (load_ord % 100) || '.py')
            WHEN 2 THEN starts_with(t.name, 'f' || load_ord || '.') OR ends_with(t.name, '.css')
            WHEN 3 THEN regexp_matches(t.path, '(^|/)src/[^/]*$') ELSE regexp_matches(t.path, '(^|/)tests/f[^/][0-4][^/]*[.]js$') OR t.name = 'Makefile' END
        AND (load_ord % 7 <> 0 OR NOT (contains(t.path, 'src/') OR contains(t.path, 'f' || load_ord)))
       GROUP BY ALL""",
    "," + PART.strip().removeprefix("WITH"),
)
ORACLES["rules_for_project"] = inv(
    f"""SELECT p.project_id, v.rule_id FROM profile p JOIN {SCOPE}
          ON len(list_intersect(string_split(v.langs, ','), p.targets)) > 0"""
)

# --- patterns ---------------------------------------------------------------------------------


def _patterns(pack, phase):
    found, rule_ord = [], 0
    for rule in pack:
        if rule.get("rule_type", "regex") != "regex":
            continue
        for pattern_ord, pattern in enumerate(rule["patterns"]):
            found.append(
                dict(
                    phase=phase, rule_ord=rule_ord, pattern_ord=pattern_ord, rule_id=rule["id"],
                    pattern=pattern, severity=rule["severity"],
                    message=rule.get("message") or rule["description"],
                    category=rule["category"], confidence=rule.get("confidence_threshold"),
                    languages=rule.get("target_languages", ["python"]),
                )
            )
        rule_ord += 1
    return found


BUILTIN = _patterns(packs.BUILTIN_PATTERNS, 0)
SHIPPED = _patterns(packs.SHIPPED_RULES, 1)


def hits(patterns, source: str) -> str:
    """One SELECT per pattern over `source`(project_id, path, line_number, line, language)."""
    parts = []
    for p in patterns:
        languages = ", ".join(q(x) for x in p["languages"])
        match = f"regexp_extract(line, {q(p['pattern'])}, 0, 'i')"
        parts.append(
            f"SELECT project_id, path, line_number, line, {p['phase']} AS phase, "
            f"{p['rule_ord']} AS rule_ord, {p['pattern_ord']} AS pattern_ord, "
            f"{q(p['rule_id'])} AS rule_id, {q(p['severity'])} AS severity, "
            f"{q(p['message'])} AS message, {q(p['category'])} AS category, "
            f"CAST({q(p['confidence'])} AS DOUBLE) AS confidence, "
            f"CAST(strpos(line, {match}) AS INTEGER) AS col "
            f"FROM {source} WHERE language IN ({languages}) "
            f"AND regexp_matches(line, {q(p['pattern'])}, 'i')"
        )
    return " UNION ALL ".join(parts)


MERGED = f"""
settled AS (
  SELECT 's' || n AS project_id, replace([{", ".join(q(x) for x in SETTINGS)}][n % 5 + 1], '{{n}}', n::VARCHAR) AS text
  FROM (SELECT event_id // {LINES_PER_FILE} AS n FROM events WHERE event_id % {LINES_PER_FILE} = 0)
), safe AS MATERIALIZED (
  SELECT project_id, CASE WHEN json_valid(text) THEN text ELSE '0' END AS text FROM settled
), merged AS MATERIALIZED (
  SELECT project_id, json_type(text) = 'OBJECT' AS usable,
         json_merge_patch(json_merge_patch({q(json.dumps(vocab.DEFAULT_SETTINGS))}::JSON, {q(json.dumps(USER_SETTINGS))}::JSON),
                          CASE WHEN json_type(text) = 'OBJECT' THEN text ELSE '{{}}' END::JSON) AS j
  FROM safe
)"""
ORACLES["project_settings"] = f"""WITH {MERGED},
leaf AS (
  SELECT project_id, t.fullkey, t.value FROM merged, json_tree(j) t
  WHERE t.fullkey <> '$' AND t.fullkey NOT LIKE '%[%' AND (t.type <> 'OBJECT' OR t.value::VARCHAR = '{{}}')
)
SELECT project_id, replace(fullkey[3:], '"', '') AS key, coalesce(TRY_CAST(value::VARCHAR AS DOUBLE)::VARCHAR, value::VARCHAR) AS value FROM leaf
UNION ALL SELECT project_id, 'config/project.json', 'bad_settings' FROM merged WHERE NOT usable"""


def settings_sql() -> str:
    columns, warnings = [], []
    for name, (low, high, default, unit, key) in vocab.OPTION_BOUNDS.items():
        section, field = key.split(".")
        # a missing value, and one that is no number, has the default
        raw = f"coalesce(CASE WHEN json_type(j, '$.{section}.{field}') IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN (j->>'$.{section}.{field}')::DOUBLE END, {float(default)})"
        columns.append(f"least(greatest({raw}, {float(low)}), {float(high)})::DOUBLE AS {name}")
        warnings.append(f"CASE WHEN {raw} < {low} THEN {q(vocab.MSG_OPTION_LOW % (key, low, unit))} WHEN {raw} > {high} THEN {q(vocab.MSG_OPTION_HIGH % (key, high, unit))} END")
    return f"WITH {MERGED} SELECT project_id, {', '.join(columns)}, concat_ws('; ', {', '.join(warnings)}) AS warnings FROM merged"


ORACLES["settings_options"] = settings_sql()

CODE_LINES = """,
codeline AS MATERIALIZED (
  SELECT project_id, path, line_number, line,
         CASE ext WHEN '.py' THEN 'python' WHEN '.js' THEN 'javascript' WHEN '.css' THEN 'stylesheet'
              ELSE 'unknown' END AS language
  FROM cline
)"""
FIRST = """
SELECT project_id, path, line_number, rule_id, pattern_ord, col AS "column" FROM hit
QUALIFY row_number() OVER (PARTITION BY project_id, path, line_number, rule_id ORDER BY pattern_ord) = 1"""
ORACLES["builtin_regex_hits"] = with_corpus(
    FIRST, CODE_LINES + f", hit AS ({hits(BUILTIN, 'codeline')})"
)
ORACLES["rule_regex_hits"] = with_corpus(
    FIRST, CODE_LINES + f", hit AS ({hits(SHIPPED, 'codeline')})"
)


def spans(patterns, source: str) -> str:
    """Every match with its span, from the lengths of the pieces between matches."""
    parts = []
    for p in patterns:
        languages = ", ".join(q(x) for x in p["languages"])
        parts.append(
            f"SELECT project_id, path, line_number, {p['phase']} AS phase, {q(p['rule_id'])} AS rule_id, "
            f"{p['pattern_ord']} AS pattern_ord, CAST({q(p['confidence'])} AS DOUBLE) AS confidence, "
            f"regexp_extract_all(line, {q(p['pattern'])}, 0, 'i') AS found, "
            f"string_split_regex(line, {q('(?i)' + p['pattern'].replace('(call|run|Popen)', '(?:call|run|Popen)'))}) AS pieces "
            f"FROM {source} WHERE language IN ({languages}) "
            f"AND regexp_matches(line, {q(p['pattern'])}, 'i')"
        )
    return " UNION ALL ".join(parts)


ORACLES["match_spans"] = with_corpus(
    """SELECT project_id, path, line_number, phase, rule_id, pattern_ord,
         CAST(k - 1 AS INTEGER) AS match_ord, CAST(start + 1 AS INTEGER) AS "column",
         CAST(start + length(found[k]) AS INTEGER) AS end_column, found[k] AS matched_text,
         coalesce(confidence, 1.0) AS confidence
       FROM (SELECT *, list_sum([length(x) for x in pieces[1:k]])
                  + coalesce(list_sum([length(x) for x in found[1:k-1]]), 0) AS start
             FROM (SELECT *, unnest(range(1, len(found) + 1)) AS k FROM span))""",
    CODE_LINES + f", span AS ({spans(BUILTIN + SHIPPED, 'codeline')})",
)
DOC_LINES = """
docline AS MATERIALIZED (
  SELECT project_id, path, 'python' AS language, CAST(k AS INTEGER) AS line_number, pieces[k] AS line
  FROM (SELECT *, unnest(range(1, len(pieces) + 1)) AS k FROM (
    SELECT source AS project_id, 'docs/d' || doc_id || '.py' AS path,
           string_split(text, chr(10)) AS pieces FROM documents))
)"""
ORACLES["secret_hits_documents"] = (
    f"WITH {DOC_LINES}, hit AS ({hits(BUILTIN + SHIPPED, 'docline')}) {FIRST}"
)
ORACLES["rule_table_hits"] = f"""WITH {DOC_LINES},
part_words AS (
  SELECT p_partkey AS k, list_transform([0, 1, 2], lambda i: string_split('{" ".join(SYLLABLES)}', ' ')[(p_partkey // pow(24, i)::BIGINT) % 24 + 1]) AS s
  FROM part
), word AS (
  SELECT k, 0 AS pattern_ord, CASE WHEN k % 7 = 0 THEN upper(s[1][1]) || s[1][2:] ELSE s[1] END || s[2] || s[3] AS w FROM part_words WHERE k % 13 <> 0
  UNION ALL SELECT k, 1, s[2] || s[1] || s[3] FROM part_words
), clean AS (
  SELECT *, ' ' || regexp_replace(line, '[^\\p{{L}}\\p{{N}}_]', ' ', 'g') || ' ' AS words FROM docline
), token AS (
  SELECT DISTINCT project_id, path, line_number, unnest(string_split(words, ' ')) AS t FROM clean
), hit AS (
  SELECT project_id, path, line_number, k, pattern_ord, t FROM token JOIN word ON t = w AND k % 7 = 0 WHERE t <> '' AND k % 5 <> 0 AND k % 11 <> 0
  UNION ALL
  SELECT DISTINCT project_id, path, line_number, k, pattern_ord, lower(t) FROM token JOIN word ON lower(t) = w AND k % 7 <> 0 WHERE t <> '' AND k % 5 <> 0 AND k % 11 <> 0
)
SELECT project_id, path AS file_path, line_number, strpos(CASE WHEN k % 7 = 0 THEN words ELSE lower(words) END, ' ' || t || ' ')::INT AS "column",
       'W' || k AS rule_id, 'LOW' AS severity, 'a word' AS message, trim(line, {q(BLANKS)}) AS code_snippet, 0.5::DOUBLE AS confidence
FROM hit JOIN clean USING (project_id, path, line_number)
QUALIFY row_number() OVER (PARTITION BY project_id, path, line_number, k ORDER BY pattern_ord) = 1"""
USER_PATTERNS = [
    ("GREETING", 0, "Th[aeiou]n", "c"), ("GREETING", 1, "the, th", "c"),
    ("REPEATED", 0, "[a-z]+tion [a-z]+tion", "c"), ("SHOUTED", 0, "nti.nti", "i"),
]
_USER_HITS = " UNION ALL ".join(
    f"SELECT project_id, path, line_number, line, 1, 0, {ord}, {q(rule)}, '', '', '', NULL, "
    f"CAST(strpos(line, regexp_extract(line, {q(p)}, 0, '{flag}')) AS INTEGER) "
    f"FROM turnline WHERE regexp_matches(line, {q(p)}, '{flag}')"
    for rule, ord, p, flag in USER_PATTERNS
)
ORACLES["conversation_hits"] = f"""WITH
turnline AS MATERIALIZED (
  SELECT project_id, path, 'python' AS language, CAST(k AS INTEGER) AS line_number, pieces[k] AS line
  FROM (SELECT *, unnest(range(1, len(pieces) + 1)) AS k FROM (
    SELECT role AS project_id, 'c' || conv_id || '/t' || turn || '.py' AS path,
           string_split(text, chr(10)) AS pieces FROM conversations))
), hit AS ({hits(BUILTIN, 'turnline')} UNION ALL {_USER_HITS}) {FIRST}"""

# --- syntax and taint -----------------------------------------------------------------------------

# Which line template produces which syntax finding; T marks those that taint raises.
SYNTAX = f""",
pyline AS (
  SELECT c.*, project_id || '/' || path AS fid FROM cline c
  WHERE ext = '.py' AND file_no % 13 <> 5
),
step AS (
  SELECT file_no, line_number AS seq, CASE tid WHEN 3 THEN 'x' WHEN 4 THEN 'y' WHEN 5 THEN 'z' ELSE 'y' END || v AS var,
         CASE tid WHEN 4 THEN 'x' || v WHEN 5 THEN 'y' || v END AS operand
  FROM pyline WHERE tid IN (3, 4, 5, 26)
),
reach(file_no, var, seq) AS (
  SELECT file_no, var, seq FROM step WHERE operand IS NULL
  UNION
  SELECT s.file_no, s.var, s.seq FROM step s JOIN reach r
    ON r.file_no = s.file_no AND r.var = s.operand AND r.seq < s.seq
),
taint AS (SELECT file_no, var, min(seq) AS seq FROM reach GROUP BY file_no, var),
call AS (
  SELECT p.*, EXISTS (
      SELECT 1 FROM taint t WHERE t.file_no = p.file_no AND t.seq < p.line_number
        AND t.var = CASE WHEN p.tid IN (6, 11) THEN 'x' || p.v WHEN p.tid IN (7, 13) THEN 'z' || p.v
                         WHEN p.tid = 9 THEN 'y' || p.v END) AS tainted
  FROM pyline p
),
astf AS (
  SELECT project_id, path, line_number, line, tid,
    CASE WHEN tid IN (6, 7) THEN 'DANGEROUS_FUNCTION_EVAL' WHEN tid = 8 THEN 'DANGEROUS_FUNCTION_EXEC'
         WHEN tid = 27 THEN 'DANGEROUS_FUNCTION___IMPORT__' WHEN tid = 28 THEN 'DANGEROUS_FUNCTION_COMPILE'
         WHEN tid IN (9, 10, 14) THEN 'COMMAND_INJECTION_001' WHEN tid IN (11, 13) THEN 'SQL_INJECTION_001'
         WHEN tid IN (1, 2, 29) THEN 'HARDCODED_SECRET_001' WHEN tid = 19 THEN 'HARDCODED_PASSWORD_001'
    END AS rule_id,
    CASE WHEN tainted THEN 'CRITICAL' WHEN tid IN (9, 10, 14, 19) THEN 'MEDIUM' ELSE 'HIGH' END AS severity,
    CASE
      WHEN tid IN (6, 7) THEN {q(vocab.MSG_DANGEROUS % 'eval')}
      WHEN tid = 8 THEN {q(vocab.MSG_DANGEROUS % 'exec')}
      WHEN tid = 27 THEN {q(vocab.MSG_DANGEROUS % '__import__')}
      WHEN tid = 28 THEN {q(vocab.MSG_DANGEROUS % 'compile')}
      WHEN tid IN (9, 10) THEN {q(vocab.MSG_COMMAND % 'os.system')}
      WHEN tid = 14 THEN {q(vocab.MSG_COMMAND % 'subprocess.run')}
      WHEN tid IN (11, 13) THEN {q(vocab.MSG_SQL % 'cursor.execute')}
      WHEN tid = 1 THEN {q(vocab.MSG_SECRET_NAME % 'password')}
      WHEN tid = 2 THEN {q(vocab.MSG_SECRET_NAME % 'api_key')}
      WHEN tid = 29 THEN {q(vocab.MSG_SECRET_NAME % 'token')}
      WHEN tid = 19 THEN {q(vocab.MSG_SECRET_STRING % 'password')}
    END AS message,
    CASE WHEN tid IN (6, 7, 8, 27, 28) THEN 'dangerous_functions'
         WHEN tid IN (9, 10, 14, 11, 13) THEN 'injection' ELSE 'hardcoded_secrets' END AS category
  FROM call
  WHERE tid IN (1, 2, 6, 7, 8, 9, 10, 11, 14, 19, 27, 28, 29) OR (tid = 13 AND tainted)
  UNION ALL
  SELECT project_id, path, line_number, NULL, NULL, 'SYNTAX_ERROR', 'LOW',
         {q(vocab.MSG_SYNTAX % "'(' was never closed")}, 'syntax'
  FROM cline WHERE ext = '.py' AND line_number = 21
)
"""


def ast_sql(where: str) -> str:
    return with_corpus(
        "SELECT project_id, path AS file_path, line_number, rule_id, severity, message "
        f"FROM astf WHERE {where}",
        SYNTAX,
    )


ORACLES["ast_dangerous"] = ast_sql("rule_id LIKE 'DANGEROUS_FUNCTION%'")
ORACLES["ast_command"] = ast_sql("rule_id = 'COMMAND_INJECTION_001'")
ORACLES["ast_sql"] = ast_sql("rule_id = 'SQL_INJECTION_001'")
ORACLES["ast_secret_assign"] = ast_sql("rule_id = 'HARDCODED_SECRET_001'")
ORACLES["ast_secret_string"] = ast_sql("rule_id = 'HARDCODED_PASSWORD_001'")
ORACLES["ast_syntax_errors"] = ast_sql("rule_id = 'SYNTAX_ERROR'")
ORACLES["call_facts"] = with_corpus(
    """SELECT call_class, name, count(*) AS n, count(*) FILTER (tid IN (9, 11, 14)) AS n_concat FROM (
         SELECT tid, CASE WHEN tid IN (6, 7) THEN 'eval' WHEN tid = 8 THEN 'exec' WHEN tid = 27 THEN '__import__'
                  WHEN tid = 28 THEN 'compile' WHEN tid IN (9, 10) THEN 'os.system'
                  WHEN tid = 14 THEN 'subprocess.run' WHEN tid IN (11, 12, 13) THEN 'cursor.execute'
                  ELSE 'input' END AS name,
                CASE WHEN tid IN (6, 7, 8, 27, 28) THEN 'dangerous' WHEN tid IN (9, 10, 14) THEN 'system'
                  WHEN tid IN (11, 12, 13) THEN 'sql' ELSE 'source' END AS call_class
         FROM pyline WHERE tid IN (3, 6, 7, 8, 9, 10, 11, 12, 13, 14, 26, 27, 28))
       GROUP BY call_class, name""",
    SYNTAX,
)
ORACLES["call_facts_by_sql"] = ORACLES["call_facts"]
ORACLES["taint_vars"] = with_corpus(
    """SELECT k.project_id, k.path, t.var FROM taint t JOIN fkey k USING (file_no)""", SYNTAX
)
ORACLES["taint_sinks"] = with_corpus(
    "SELECT project_id, path AS file_path, line_number, rule_id FROM astf WHERE severity = 'CRITICAL'",
    SYNTAX,
)
ORACLES["python_syntax_findings"] = with_corpus(
    """SELECT project_id, path AS file_path, line_number, rule_id, severity, message, category,
         trim(line) AS code_snippet FROM astf""",
    SYNTAX,
)

# --- findings -------------------------------------------------------------------------------------


def scan_ctes(included: str = "included", keep: str = "phase, rule_ord, pattern_ord") -> str:
    """CTE `found`: the findings of a full scan."""
    return (
        INVENTORY
        + SYNTAX
        + f""",
scanline AS MATERIALIZED (
  SELECT c.project_id, c.path, c.line_number, c.line, i.language
  FROM cline c JOIN {included} i ON i.project_id = c.project_id AND i.path = c.path
),
hit AS ({hits(BUILTIN + SHIPPED, 'scanline')}),
raw AS (
  SELECT project_id, path AS file_path, line_number, col AS "column", rule_id, severity, message,
         category, trim(line) AS code_snippet, confidence, phase, rule_ord, pattern_ord FROM hit
  UNION ALL
  SELECT a.project_id, a.path, a.line_number, NULL, a.rule_id, a.severity, a.message, a.category,
         trim(a.line), NULL, 2, 0, a.line_number
  FROM astf a JOIN {included} i ON i.project_id = a.project_id AND i.path = a.path
),
sev AS (SELECT * FROM {values([(k, *v) for k, v in vocab.SEVERITIES.items()], 'severity, rank, ord, penalty')}),
found AS (
  SELECT raw.* EXCLUDE (phase, rule_ord, pattern_ord) FROM raw JOIN sev USING (severity)
  QUALIFY row_number() OVER (PARTITION BY project_id, file_path, line_number, rule_id ORDER BY {keep}) = 1
)"""
    )


FOUND = (
    'project_id, file_path, line_number, "column", rule_id, severity, message, category, '
    "code_snippet, confidence"
)


def scan_sql(body: str, more: str = "", **how) -> str:
    return with_corpus(body, scan_ctes(**how) + more)


ALL_FOUND = scan_sql(f"SELECT {FOUND} FROM found")
ORACLES["findings_dedup"] = ALL_FOUND
ORACLES["finding_roundtrip"] = ALL_FOUND
ORACLES["incremental_corpus"] = ALL_FOUND
ORACLES["findings_max_severity"] = scan_sql(
    f"SELECT {FOUND} FROM found", keep="sev.rank, phase, rule_ord, pattern_ord"
)
ORACLES["findings_all_files"] = scan_sql(f"SELECT {FOUND} FROM found", included="included_js")
ORACLES["findings_min_severity"] = scan_sql(
    f"SELECT {FOUND} FROM found JOIN sev USING (severity) WHERE ord >= 3"
)
ORACLES["findings_of_severity"] = scan_sql(f"SELECT {FOUND} FROM found WHERE severity = 'MEDIUM'")
ORACLES["findings_high_priority"] = scan_sql(
    f"SELECT {FOUND} FROM found WHERE severity IN ('CRITICAL', 'HIGH')"
)
ORACLES["findings_policy"] = scan_sql(
    f"""SELECT {FOUND} FROM found WHERE severity <> 'INFO' AND coalesce(confidence, 1.0) >= 0.7
          AND rule_id NOT IN ('XSS_001', 'HARDCODED_SECRET_001')"""
)
META = values(
    [(r["id"], r["cwe_id"], r["owasp_category"]) for r in packs.SHIPPED_RULES],
    "rule_id, cwe_id, owasp_category",
)
ORACLES["findings_enriched"] = scan_sql(
    f"""SELECT f.project_id, f.file_path, f.line_number, f.rule_id, v.cwe_id, v.owasp_category
        FROM found f LEFT JOIN {META} USING (rule_id)"""
)
ORACLES["findings_display"] = scan_sql(
    """SELECT project_id, rule_id, loc AS location,
         '[' || severity || '] ' || message || ' (' || loc || ')' AS display,
         array_to_string(string_split(file_path, '/')[-2:], '/') AS short_path,
         CASE WHEN length(message) > 45 THEN message[1:45] || '...' ELSE message END AS short_message
       FROM (SELECT *, file_path || ':' || line_number || coalesce(':' || "column", '') AS loc FROM found)"""
)
PLACE = "file_path, line_number, rule_id"
ORACLES["findings_top10"] = scan_sql(
    f"SELECT {FOUND} FROM found JOIN sev USING (severity) ORDER BY rank, project_id, {PLACE} LIMIT 10"
)
ORACLES["findings_top3_per_project"] = scan_sql(
    f"""SELECT project_id, CAST(row_number() OVER w AS INTEGER) AS rank, file_path, line_number, rule_id, severity
        FROM found JOIN (SELECT severity, rank AS sev_rank FROM sev) USING (severity)
        WINDOW w AS (PARTITION BY project_id ORDER BY sev_rank, {PLACE})
        QUALIFY row_number() OVER w <= 3"""
)
ORACLES["findings_top5_per_severity"] = scan_sql(
    f"""SELECT severity, CAST(row_number() OVER w AS INTEGER) AS rank, project_id, file_path, line_number, rule_id
        FROM found WINDOW w AS (PARTITION BY severity ORDER BY project_id, {PLACE})
        QUALIFY row_number() OVER w <= 5"""
)
ORACLES["findings_top2000_per_severity"] = scan_sql(
    f"""SELECT severity, CAST(row_number() OVER w AS INTEGER) AS rank, project_id, file_path, line_number, rule_id
        FROM found WINDOW w AS (PARTITION BY severity ORDER BY project_id, {PLACE})
        QUALIFY row_number() OVER w <= 2000"""
)
ORACLES["findings_csv"] = scan_sql(
    "SELECT file_path AS Arquivo, line_number AS Linha, severity AS Severidade, rule_id AS Regra, "
    "message AS Mensagem FROM found"
)
ORACLES["family_coverage"] = scan_sql(
    f"""SELECT family, count(f.rule_id) AS n, count(f.rule_id) > 0 AS detected
        FROM {values([(x,) for x in vocab.EXPECTED_FAMILIES], 'family')}
        LEFT JOIN found f ON contains(f.rule_id, v.family) GROUP BY family"""
)

# --- scoring --------------------------------------------------------------------------------------

COUNTS = ", ".join(
    f"count(*) FILTER (severity = '{s}') AS {s.lower()}_count" for s in vocab.SEVERITIES
)
ORACLES["severity_counts"] = scan_sql(
    f"""SELECT project_id, {", ".join(f"coalesce({s.lower()}_count, 0) AS {s.lower()}_count" for s in vocab.SEVERITIES)},
               coalesce(total_findings, 0) AS total_findings
        FROM profile LEFT JOIN (SELECT project_id, {COUNTS}, count(*) AS total_findings FROM found GROUP BY project_id) USING (project_id)"""
)
SUMMARY = (
    f"SELECT project_id, {COUNTS}, count(*) AS total_findings, "
    "greatest(0.0, 100.0 - sum(penalty)) AS security_score "
    "FROM found JOIN sev USING (severity) GROUP BY project_id"
)
SUMMARY_COLUMNS = ", ".join(
    ["project_id", *[f"{s.lower()}_count" for s in vocab.SEVERITIES], "total_findings",
     "CAST(security_score AS DOUBLE) AS security_score"]
)
ORACLES["report_roundtrip"] = scan_sql(
    f"""SELECT project_id, {", ".join(f"coalesce({s.lower()}_count, 0) AS {s.lower()}_count" for s in vocab.SEVERITIES)},
               coalesce(total_findings, 0) AS total_findings, CAST(coalesce(security_score, 100.0) AS DOUBLE) AS security_score
        FROM profile LEFT JOIN ({SUMMARY}) USING (project_id)"""
)
ORACLES["tracked_summary"] = ORACLES["report_roundtrip"]
ORACLES["report_json"] = scan_sql(
    f"""SELECT h.project_id, h.part, h.n_parts, to_json({{
          'target_path': h.project_id, 'scan_started_at': '2024-01-01T00:00:00', 'scan_duration': NULL,
          'analyzer_version': {q(vocab.REPORT_VERSION)},
          'summary': {{'total_findings': total_findings, {", ".join(f"'{s.lower()}_count': {s.lower()}_count" for s in vocab.SEVERITIES)},
                      'security_score': security_score}},
          'findings': coalesce(findings, [])}})::VARCHAR AS json
        FROM (SELECT *, unnest(range(n_parts))::INTEGER AS part FROM totals) h LEFT JOIN dealt d USING (project_id, part)""",
    f""",
totals AS (
  SELECT p.project_id, {", ".join(f"coalesce({s.lower()}_count, 0) AS {s.lower()}_count" for s in vocab.SEVERITIES)},
         coalesce(total_findings, 0) AS total_findings, CAST(coalesce(security_score, 100.0) AS DOUBLE) AS security_score,
         greatest(ceil(coalesce(total_findings, 0) / 200), 1)::INTEGER AS n_parts
  FROM profile p LEFT JOIN ({SUMMARY}) s USING (project_id)
),
dealt AS (
  SELECT f.project_id,
         (('0x' || substr(md5(f.file_path || ':' || coalesce(f.line_number || ':', '') || f.rule_id), 1, 8))::BIGINT % t.n_parts)::INTEGER AS part,
         list({{'file_path': file_path, 'line_number': line_number, 'column': "column", 'rule_id': rule_id, 'severity': severity,
               'message': message, 'category': category, 'cwe_id': NULL, 'confidence': confidence, 'code_snippet': code_snippet,
               'found_at': NULL}} ORDER BY file_path, line_number NULLS FIRST, rule_id) AS findings
  FROM found f JOIN totals t USING (project_id) GROUP BY ALL
)""",
)
ORACLES["merged_totals"] = scan_sql(f"SELECT {SUMMARY_COLUMNS} FROM ({SUMMARY})")
FILE_SCORES = """,
fscore AS (
  SELECT k.project_id || '/' || k.path AS project_id, count(f.rule_id) AS total_findings,
         count(*) FILTER (f.severity = 'CRITICAL') AS critical,
         count(*) FILTER (f.severity = 'HIGH') AS high,
         CAST(greatest(0.0, 100.0 - coalesce(sum(s.penalty), 0)) AS DOUBLE) AS security_score
  FROM fkey k LEFT JOIN found f ON f.project_id = k.project_id AND f.file_path = k.path
  LEFT JOIN sev s ON s.severity = f.severity GROUP BY k.project_id, k.path
)"""
ORACLES["security_score"] = scan_sql(
    "SELECT project_id, total_findings, security_score FROM fscore", FILE_SCORES
)
CLASS = (
    "CASE WHEN security_score IS NULL THEN NULL WHEN security_score = 100 THEN 'clean' "
    "WHEN security_score >= 90 THEN 'excellent' WHEN security_score >= 75 THEN 'good' "
    "WHEN security_score < 50 AND security_score >= 25 THEN 'poor' ELSE 'critical' END"
)
BAND = (
    "CASE WHEN security_score >= 90 THEN 90 WHEN security_score >= 75 THEN 75 "
    "WHEN security_score >= 50 THEN 50 WHEN security_score >= 25 THEN 25 ELSE 0 END"
)
LABEL = values(list(vocab.SCORE_LABELS.items()), "score_class, score_label")
ORACLES["score_class"] = scan_sql(
    f"""SELECT score_class, v.score_label, score_band, count(*) AS n, min(security_score) AS lowest
        FROM (SELECT *, {CLASS} AS score_class, {BAND} AS score_band FROM fscore)
        JOIN {LABEL} USING (score_class) GROUP BY ALL""",
    FILE_SCORES,
)
GATE = "CASE WHEN {c} > 0 THEN 2 WHEN {h} > 5 THEN 1 ELSE 0 END"
ORACLES["gate"] = scan_sql(
    f"""SELECT project_id, {GATE.format(c='critical', h='high')} AS gate_code,
          total_findings = 0 AS is_clean, critical > 0 AS has_critical_issues FROM fscore""",
    FILE_SCORES,
)
ORACLES["rules_triggered"] = scan_sql(
    """SELECT project_id, count(DISTINCT rule_id) AS rules_triggered
       FROM profile LEFT JOIN found USING (project_id) GROUP BY project_id"""
)
ORACLES["scan_errors"] = with_corpus(
    f"""SELECT project_id, NULL AS path, 'unsupported_language' AS reason, NULL AS message
        FROM (SELECT project_id || '-' || string_split(path, '/')[1] AS project_id, path, ext FROM cfile)
        GROUP BY project_id
        HAVING NOT bool_or(ext = '.py' AND NOT regexp_matches(
          path, '(^|/)(build|node_modules|venv|env)(/|$)'))
        UNION ALL
        SELECT source, 'docs/d' || doc_id || '.py', 'file_too_large', 'docs/d' || doc_id || '.py: ' ||
          replace({q(vocab.MSG_OVERSIZE)}, '%s', CAST(octet_length(encode(text)) AS VARCHAR))
        FROM documents WHERE octet_length(encode(text)) > 0.1 * 1024 * 1024"""
)
ORACLES["scan_stats"] = scan_sql(
    f"""SELECT p.project_id,
          (SELECT count(*) FROM included i WHERE i.project_id = p.project_id) AS files_analyzed,
          CAST(0 AS BIGINT) AS files_skipped,
          (SELECT count(*) FROM {SCOPE}
           WHERE len(list_intersect(string_split(v.langs, ','), p.targets)) > 0) AS rules_applied,
          (SELECT count(DISTINCT rule_id) FROM found f WHERE f.project_id = p.project_id) AS rules_triggered,
          CAST((SELECT coalesce(sum({newlines('i.text')}), 0) FROM included i
                WHERE i.project_id = p.project_id) AS BIGINT) AS total_lines_scanned
        FROM profile p"""
)

TROUBLED = """
trouble AS (
  SELECT event_id // 400 AS n, (event_id // 400) % 5 AS kind, 'trouble' || ((event_id // 400) % 3) AS project_id,
         't/f' || (event_id // 400) || '.py' AS path
  FROM events WHERE event_id % 400 = 0
)"""
ORACLES["troubled_findings"] = f"""WITH {TROUBLED}
SELECT project_id, path, what FROM trouble JOIN (VALUES
  (0, 'unreadable'), (1, 'unreadable'), (2, 'syntax_aborted'), (3, 'SYNTAX_ERROR')) AS w(kind, what) USING (kind)"""
ORACLES["result_records"] = scan_sql(
    """SELECT project_id, greatest(ceil(n / 200), ceil(e / 200), 1)::BIGINT AS n_parts, greatest(ceil(n / 200), ceil(e / 200), 1)::INTEGER AS n_parts_said,
         n AS total_findings, n AS n_findings, n AS n_dated, e AS n_errors, r AS rules_triggered
       FROM (SELECT project_id, count(rule_id) AS n, CASE WHEN project_id IN (SELECT project_id FROM included) THEN 0 ELSE 1 END AS e, count(DISTINCT rule_id) AS r
             FROM profile LEFT JOIN found USING (project_id) GROUP BY project_id
             UNION ALL
             SELECT project_id, count(*) FILTER (kind = 3), count(*) FILTER (kind < 3), count(DISTINCT kind) FILTER (kind = 3) FROM trouble GROUP BY project_id)""",
    "," + TROUBLED,
)
ORACLES["first_errors"] = f"""WITH {TROUBLED}
SELECT project_id, path, CASE WHEN kind = 2 THEN 'syntax_aborted' ELSE 'unreadable' END AS reason
FROM trouble WHERE kind IN (0, 1, 2) ORDER BY project_id, path, reason LIMIT 20"""
ORACLES["file_accounting"] = inv(
    f"""SELECT p.project_id,
          (SELECT count(*) FROM afile a WHERE a.project_id = p.project_id) AS files_in,
          (SELECT count(*) FROM included i WHERE i.project_id = p.project_id) AS analyzed,
          (SELECT count(*) FROM afile a WHERE a.project_id = p.project_id)
            - (SELECT count(*) FROM included i WHERE i.project_id = p.project_id) AS excluded,
          0 AS unknown_language, 0 AS file_too_large, 0 AS unreadable, 0 AS syntax_aborted, 0 AS analysis_error
        FROM profile p
        UNION ALL
        SELECT project_id, count(*), count(*) FILTER (kind = 3 OR kind = 4 AND project_id <> 'trouble0'), 0, 0,
          count(*) FILTER (kind = 4 AND project_id = 'trouble0'), count(*) FILTER (kind IN (0, 1)),
          count(*) FILTER (kind = 2), 0
        FROM trouble GROUP BY project_id""",
    "," + TROUBLED,
)
_ZEROS = [f"{s.lower()}_count" for s in vocab.SEVERITIES] + ["total_findings"]
ORACLES["scan_summary"] = scan_sql(
    f"""SELECT project_id, {", ".join(_ZEROS)}, security_score, {CLASS} AS score_class,
          v.score_label, {BAND} AS score_band,
          CASE WHEN security_score IS NOT NULL THEN {GATE.format(c='critical_count', h='high_count')} END AS gate_code,
          CASE WHEN security_score IS NOT NULL THEN total_findings = 0 END AS is_clean,
          CASE WHEN security_score IS NOT NULL THEN critical_count > 0 END AS has_critical_issues
        FROM (SELECT p.project_id, {", ".join(f"coalesce(s.{z}, 0) AS {z}" for z in _ZEROS)},
                CASE WHEN p.project_id IN (SELECT project_id FROM included)
                     THEN CAST(coalesce(s.security_score, 100.0) AS DOUBLE) END AS security_score
              FROM profile p LEFT JOIN ({SUMMARY}) s USING (project_id))
        LEFT JOIN {LABEL} ON v.score_class = {CLASS}"""
)
ORACLES["tree_summary"] = ORACLES["scan_summary"]

ORACLES["incremental_scan"] = f"""WITH {DOC_LINES}, hit AS ({hits(BUILTIN + SHIPPED, 'docline')})
SELECT project_id, path AS file_path, line_number, col AS "column", rule_id, severity, message,
       category, trim(line) AS code_snippet, confidence FROM hit
QUALIFY row_number() OVER (PARTITION BY project_id, path, line_number, rule_id ORDER BY pattern_ord) = 1"""
