"""A source-code corpus derived from the driver's `events` table, one line per event.

The tables hold almost no code-like text, so queries over code read this corpus. It
grows with `events`. `SQL` is its twin for the DuckDB comparison.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codesieve.functions.literals import literal_array, quote
from codesieve.operators import options as O
from codesieve.sources.files import spread

LINES_PER_FILE = 20

# Line templates by number; {u} is the user id, {v} is the user id modulo 3.
TEMPLATES = [
    'import os',
    'password = "pw_{u}_secret"',
    'api_key = "abcdef{u}0123456789"',
    'x{v} = input("q")',
    'y{v} = "cmd " + x{v}',
    'z{v} = y{v} + " end"',
    'eval(x{v})',
    'eval(z{v})',
    'exec("1")',
    'os.system("ls " + y{v})',
    'os.system("date")',
    'cursor.execute("SELECT * FROM t WHERE id = " + x{v})',
    'cursor.execute("SELECT * FROM t WHERE id = ?", (1,))',
    'cursor.execute(z{v})',
    'subprocess.run("ls " + d{v}, shell=True)',
    'h = hashlib.md5(b"{u}").hexdigest()',
    'app.debug = True',
    'DEBUG = True',
    'if password == "admin{u}": pass',
    's = "password: \'hunter{u}x\'"',
    'element.innerHTML = "a" + b{v}',
    'out = render_template_string(tpl)',
    'n = {u}',
    '# comment eval(x)',
    '',
    'w{v} = x{v}.strip()',
    'y{v} = input("a").strip()',
    '__import__("os")',
    'c = compile("1", "f", "exec")',
    'token = "tok{u}ABCDEFGHIJKLMNOPQRS"',
    'print("é😀 ok")  # secret_key = "abcdefghij{u}"',
    'q = "UPDATE t SET a = " + a{v}',
]
DIRECTORIES = [
    'app', 'src', 'src/core', 'tests', 'build', 'node_modules/x', 'src/env', 'lib/a/b/c',
    'venv/lib', 'dev',
]
SUFFIXES = ['.py', '.py', '.py', '.js', '.pyw', '.css']
BROKEN_LINE = 'def broken('

# Files at the top of a project: (project number, name, content).
ROOT_FILES = [
    (0, 'requirements.txt', 'flask==2.0\n'),
    (0, 'setup.py', 'setup(name="alpha-tool", version="1.0")\n'),
    (1, 'package.json', '{"name": "beta-web", "version": "1.0.0"}\n'),
    (1, 'yarn.lock', '# lock\n'),
    (2, 'pom.xml', '<project></project>\n'),
    (2, 'build.gradle', 'apply plugin: "java"\n'),
    (3, 'Makefile', 'all:\n'),
    (4, 'tools.csproj', '<Project></Project>\n'),
    (4, 'tools.sln', 'Solution\n'),
    (5, 'requirements.txt', 'django==4.2\n'),
    (5, 'package.json', '{broken\n'),
    (5, 'tsconfig.json', '{}\n'),
    (6, 'Cargo.toml', '[package]\n'),
    (6, 'go.mod', 'module gamma\n'),
    (6, 'go.sum', '\n'),
    (8, 'pyproject.toml', '[project]\n'),
    (8, 'requirements.txt', 'numpy\n'),
    (8, 'setup.py', 'setup(version="2.0")\n'),
]


def corpus_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of nine projects: (project_id, path, size_bytes, last_modified, content)."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id")
    tid = (F.col("event_id") * 7 + F.col("user_id") * 3) % 32
    line = F.element_at(literal_array(TEMPLATES), (tid + 1).cast("int"))
    line = F.replace(line, F.lit("{u}"), F.col("user_id").cast("string"))
    line = F.replace(line, F.lit("{v}"), (F.col("user_id") % 3).cast("string"))
    file_no = F.expr(f"event_id div {LINES_PER_FILE}")
    # The partition count is fixed because reading source costs far more than its size tells.
    # A file is exactly LINES_PER_FILE events, so the collected group has a fixed size.
    per_file = (
        events.select(
            file_no.alias("file_no"), "ts", F.struct("event_id", line.alias("line")).alias("row")
        )
        .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "file_no")
        .groupBy("file_no")
        .agg(F.min("ts").alias("last_modified"), F.array_sort(F.collect_list("row")).alias("rows"))
    )
    n = F.col("file_no")
    text = F.concat(
        F.array_join(F.transform("rows", lambda r: r["line"]), "\n"),
        F.when(n % 13 == 5, "\n" + BROKEN_LINE).otherwise(""),
    )
    directory = F.element_at(literal_array(DIRECTORIES), (n % 10 + 1).cast("int"))
    suffix = F.element_at(literal_array(SUFFIXES), (F.expr("file_no div 10") % 6 + 1).cast("int"))
    return per_file.select(
        F.concat(F.lit("proj"), n % 9).alias("project_id"),
        F.concat(directory, F.lit("/f"), n, suffix).alias("path"),
        F.octet_length(text).cast("bigint").alias("size_bytes"),
        "last_modified",
        text.cast("binary").alias("content"),
    )


def corpus_root_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-level files of the projects that occur in the corpus."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    number = F.expr(f"event_id div {LINES_PER_FILE}") % 9
    projects = events.groupBy(number.alias("number")).agg(F.min("ts").alias("last_modified"))
    rows = [
        f"struct({k}L AS number, {quote(name)} AS path, {quote(content)} AS text)"
        for k, name, content in ROOT_FILES
    ]
    roots = F.expr(f"array({', '.join(rows)})")
    mine = F.filter(roots, lambda r: r["number"] == F.col("number"))
    return projects.select("number", "last_modified", F.explode(mine).alias("r")).select(
        F.concat(F.lit("proj"), "number").alias("project_id"),
        F.col("r.path").alias("path"),
        F.octet_length("r.text").cast("bigint").alias("size_bytes"),
        "last_modified",
        F.col("r.text").cast("binary").alias("content"),
    )


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_files(spark, sf_dir).unionByName(corpus_root_files(spark, sf_dir))


def troubled_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file for each 20th file of the corpus, in turn: no size, no content, syntax that is too deep, a NUL
    byte, one that is too large for the smallest limit."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").where("event_id % 400 = 0")
    n = F.expr("event_id div 400")
    kind = n % 5
    text = (
        F.when(kind == 2, F.concat(F.lit("x = "), F.repeat(F.lit("-"), F.lit(100_000)), F.lit("1\n")))
        .when(kind == 3, F.lit("a = 1\neval(b)\x00\n"))
        .when(kind == 4, F.repeat(F.lit("# filler\n"), F.lit(13_000)))
        .otherwise(F.lit("eval(c)\n"))
    )
    return events.select(
        F.concat(F.lit("trouble"), n % 3).alias("project_id"),
        F.concat(F.lit("t/f"), n, F.lit(".py")).alias("path"),
        F.when(kind != 0, F.octet_length(text).cast("bigint")).alias("size_bytes"),
        F.col("ts").alias("last_modified"),
        F.when(kind != 1, text.cast("binary")).alias("content"),
    )


# Settings files by number modulo 5; {n} is the number of the project.
SETTINGS = [
    '{"analysis": {"max_depth": {n}, "max_file_size_mb": 0.25}, "rules": {"disabled_rules": ["R{n}"], "min_confidence": 0.5}}',
    '{"analysis": 7, "extra": {"deep": {"on": true, "none": {}}}}',
    '{"reports": {}, "analysis": {"max_workers": {"of": {n}}}, "user": {}}',
    '{broken',
    '["no", "object"]',
]


def settings_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A project with a settings file for each file of the corpus."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").where(f"event_id % {LINES_PER_FILE} = 0")
    n = F.expr(f"event_id div {LINES_PER_FILE}")
    text = F.replace(F.element_at(literal_array(SETTINGS), (n % 5 + 1).cast("int")), F.lit("{n}"), n.cast("string"))
    return events.select(F.concat(F.lit("s"), n).alias("project_id"), F.lit("config/project.json").alias("path"), text.cast("binary").alias("content"))


def some_options(files: DataFrame) -> DataFrame:
    """The smallest size limit for one project; the others have no row."""
    one = files.where("project_id = 'trouble0'").select("project_id").distinct()
    return O.layer_options(one, call={"max_file_size_mb": 0.1})


def document_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The `documents` table seen as text files, one project per source."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return spread(documents).select(
        F.col("source").alias("project_id"),
        F.concat(F.lit("docs/d"), "doc_id", F.lit(".py")).alias("path"),
        F.octet_length("text").cast("bigint").alias("size_bytes"),
        F.lit(None).cast("timestamp").alias("last_modified"),
        F.col("text").cast("binary").alias("content"),
    )


def page_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The `pages` table as files; the path of the URL is the path of the file."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages.select(
        F.regexp_extract("url", "^https?://([^/]+)", 1).alias("project_id"),
        F.concat(F.regexp_extract("url", "^https?://[^/]+/([^?#]*)", 1), F.lit(".css")).alias("path"),
        F.octet_length("html").cast("bigint").alias("size_bytes"),
        F.lit(None).cast("timestamp").alias("last_modified"),
        F.col("html").cast("binary").alias("content"),
    )


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def _sql_list(values: list) -> str:
    return "[" + ", ".join(_quote(v) for v in values) + "]"


SQL = f"""
ev AS (
  SELECT event_id, ts, user_id, event_id // {LINES_PER_FILE} AS file_no,
         (event_id * 7 + user_id * 3) % 32 AS tid, user_id % 3 AS v
  FROM events
),
tline AS (
  SELECT file_no, event_id, ts, tid, v, event_id % {LINES_PER_FILE} + 1 AS line_number,
         replace(replace({_sql_list(TEMPLATES)}[tid + 1], '{{u}}', CAST(user_id AS VARCHAR)),
                 '{{v}}', CAST(v AS VARCHAR)) AS line
  FROM ev
),
fkey AS (
  SELECT file_no, 'proj' || (file_no % 9) AS project_id,
         {_sql_list(DIRECTORIES)}[file_no % 10 + 1] || '/f' || file_no ||
         {_sql_list(SUFFIXES)}[(file_no // 10) % 6 + 1] AS path,
         {_sql_list(SUFFIXES)}[(file_no // 10) % 6 + 1] AS ext,
         min(ts) AS last_modified
  FROM ev GROUP BY file_no
),
allline AS (
  SELECT file_no, line_number, line, tid, v FROM tline
  UNION ALL
  SELECT file_no, {LINES_PER_FILE} + 1, '{BROKEN_LINE}', NULL, NULL FROM fkey WHERE file_no % 13 = 5
),
cfile AS (
  SELECT k.project_id, k.path, k.ext, k.file_no, k.last_modified,
         string_agg(l.line, chr(10) ORDER BY l.line_number) AS text
  FROM fkey k JOIN allline l USING (file_no)
  GROUP BY k.project_id, k.path, k.ext, k.file_no, k.last_modified
),
croot AS (
  SELECT p.project_id, r.path, r.text, p.last_modified
  FROM (SELECT project_id, min(last_modified) AS last_modified FROM fkey GROUP BY project_id) p
  JOIN (VALUES {", ".join(f"('proj{k}', {_quote(n)}, {_quote(c)})" for k, n, c in ROOT_FILES)})
    AS r(project_id, path, text) ON r.project_id = p.project_id
),
afile AS (
  SELECT project_id, path, text, octet_length(encode(text)) AS size_bytes, last_modified FROM cfile
  UNION ALL
  SELECT project_id, path, text, octet_length(encode(text)), last_modified FROM croot
),
cline AS (
  SELECT k.project_id, k.path, k.ext, l.file_no, l.line_number, l.line, l.tid, l.v
  FROM allline l JOIN fkey k USING (file_no)
  -- an empty last line is only the break of the line before it
  WHERE NOT (l.line = '' AND l.line_number = {LINES_PER_FILE} AND l.file_no % 13 <> 5)
)
"""


def with_corpus(body: str, more: str = "") -> str:
    """A DuckDB statement whose FROM may name the corpus tables."""
    return f"WITH RECURSIVE {SQL}{more} {body}"
