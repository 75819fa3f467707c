"""Table schemas shared by sources, operators and sinks. Importable without a session."""

from pyspark.sql import types as T

TEXT = T.StringType()
TEXTS = T.ArrayType(TEXT)
INT = T.IntegerType()
LONG = T.LongType()
DOUBLE = T.DoubleType()
FLAG = T.BooleanType()
MOMENT = T.TimestampType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def extend(schema: T.StructType, **fields: T.DataType) -> T.StructType:
    return T.StructType(schema.fields + struct(**fields).fields)


METADATA = struct(
    cwe_id=TEXT,
    owasp_category=TEXT,
    references=TEXTS,
    tags=TEXTS,
    author=TEXT,
    created_date=TEXT,
    last_updated=TEXT,
)

RULE = struct(
    id=TEXT,
    name=TEXT,
    description=TEXT,
    severity=TEXT,
    category=TEXT,
    rule_type=TEXT,
    patterns=TEXTS,
    target_languages=TEXTS,
    file_patterns=TEXTS,
    excluded_paths=TEXTS,
    case_sensitive=FLAG,
    multiline=FLAG,
    enabled=FLAG,
    confidence_threshold=DOUBLE,
    metadata=METADATA,
)
# A rule as it was read, and a rule with its place in the load order.
RAW_RULE = extend(RULE, _corrupt_record=TEXT)
LOADED_RULE = extend(RULE, load_ord=LONG)

# One row per source file. `content` holds the raw bytes.
FILE = struct(
    project_id=TEXT, path=TEXT, size_bytes=LONG, last_modified=MOMENT, content=T.BinaryType()
)
BINARY_FILE = struct(path=TEXT, modificationTime=MOMENT, length=LONG, content=T.BinaryType())

# Column order of every findings table.
FINDING = struct(
    project_id=TEXT,
    file_path=TEXT,
    line_number=INT,
    column=INT,
    rule_id=TEXT,
    severity=TEXT,
    message=TEXT,
    category=TEXT,
    cwe_id=TEXT,
    code_snippet=TEXT,
    confidence=DOUBLE,
    found_at=MOMENT,
)

# Findings before de-duplication also say where they came in the order of detection.
FINDING_ORDER = ["phase", "rule_ord", "pattern_ord", "match_ord"]

FINDING_JSON = struct(
    file_path=TEXT,
    line_number=INT,
    column=INT,
    rule_id=TEXT,
    severity=TEXT,
    message=TEXT,
    category=TEXT,
    cwe_id=TEXT,
    confidence=DOUBLE,
    code_snippet=TEXT,
    found_at=TEXT,
)

SUMMARY_JSON = struct(
    total_findings=LONG,
    critical_count=LONG,
    high_count=LONG,
    medium_count=LONG,
    low_count=LONG,
    info_count=LONG,
    security_score=DOUBLE,
)

REPORT_JSON = struct(
    target_path=TEXT,
    scan_started_at=TEXT,
    scan_duration=DOUBLE,
    analyzer_version=TEXT,
    summary=SUMMARY_JSON,
    findings=T.ArrayType(FINDING_JSON),
)

PROJECT = struct(
    name=TEXT,
    root_path=TEXT,
    description=TEXT,
    created_at=TEXT,
    last_scanned=TEXT,
    target_languages=TEXTS,
    excluded_paths=TEXTS,
    included_extensions=TEXTS,
)

# Syntax facts of a Python file, in visiting order.
ARGUMENT = struct(
    kind=TEXT,  # 'name' or 'binop'; other arguments are left out
    name=TEXT,
    left=TEXT,  # operand names, null where an operand is not a plain name
    right=TEXT,
    is_add=FLAG,
    plain_side=FLAG,  # one side is a constant or a name
)
FACT = struct(
    kind=TEXT,  # call, assign, str, syntax_error, error, aborted
    seq=INT,  # place in the pre-order walk
    lineno=INT,
    name=TEXT,  # call: dotted name
    args=T.ArrayType(ARGUMENT),
    kw_add=FLAG,
    targets=TEXTS,
    value=TEXT,  # assign: 'source', 'add' or 'str'
    left=TEXT,
    right=TEXT,
    text=TEXT,  # str: its value; errors: the message
    line_concat=FLAG,  # call: its line has a plus sign and a SQL verb
    line_target=TEXT,  # call: variable its line assigns from input(
)
FACTS = T.ArrayType(FACT)
TAINT = T.ArrayType(struct(var=TEXT, seq=INT))
FOLLOWED = struct(taint=TAINT, flags=T.ArrayType(FLAG))

# A syntax finding inside the row of its file.
SYNTAX_FINDING = struct(
    line_number=INT,
    rule_id=TEXT,
    seq=INT,
    idx=INT,
    severity=TEXT,
    message=TEXT,
    category=TEXT,
    has_line=FLAG,
)
# A finding before de-duplication, inside the row of its file; the first fields are its order.
CANDIDATE = struct(
    line_number=INT,
    rule_id=TEXT,
    phase=INT,
    rule_ord=INT,
    pattern_ord=INT,
    match_ord=INT,
    column=INT,
    severity=TEXT,
    message=TEXT,
    category=TEXT,
    confidence=DOUBLE,
    has_line=FLAG,
)
CANDIDATES = T.ArrayType(CANDIDATE)
SPANS = T.ArrayType(struct(start=INT, stop=INT, matched_text=TEXT))
