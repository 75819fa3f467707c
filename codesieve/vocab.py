"""Lists, lookup tables and message texts that results depend on.

Everything in this file must stay equal to the published behaviour for results
to match; there is no logic here. Order matters where a comment says so.
"""

# --- severities: name -> (display rank, threshold order, penalty) -------------
SEVERITIES = {
    "CRITICAL": (0, 4, 10),
    "HIGH": (1, 3, 7),
    "MEDIUM": (2, 2, 5),
    "LOW": (3, 1, 3),
    "INFO": (4, 0, 1),
}

# --- rule enumerations --------------------------------------------------------
CATEGORIES = [
    "injection",
    "broken_authentication",
    "sensitive_data",
    "xxe",
    "broken_access_control",
    "security_misconfiguration",
    "xss",
    "insecure_deserialization",
    "vulnerable_components",
    "logging_monitoring",
    "hardcoded_secrets",
    "dangerous_functions",
    "cryptography",
]
RULE_TYPES = ["regex", "ast", "pattern", "semantic", "configuration"]

# --- file extension -> language ----------------------------------------------
EXTENSION_LANGUAGE = {
    ".py": "python",
    ".js": "javascript",
    ".ts": "typescript",
    ".jsx": "javascript",
    ".tsx": "typescript",
    ".java": "java",
    ".cpp": "cpp",
    ".cc": "cpp",
    ".cxx": "cpp",
    ".c": "c",
    ".h": "c",
    ".hpp": "cpp",
    ".php": "php",
    ".rb": "ruby",
    ".go": "go",
    ".rs": "rust",
    ".cs": "csharp",
    ".css": "stylesheet",
}
UNKNOWN_LANGUAGE = "unknown"

# Extensions that make a directory a valid project and that are counted when no
# indicator file exists. The order decides ties.
CODE_EXTENSIONS = [
    ".py", ".js", ".ts", ".java", ".cpp", ".c", ".php", ".rb", ".go", ".rs", ".cs",
]

# Indicator files per language. The order of languages decides ties.
INDICATORS = {
    "python": [
        "requirements.txt", "setup.py", "pyproject.toml", "Pipfile", "poetry.lock", "conda.yml",
    ],
    "javascript": [
        "package.json", "package-lock.json", "yarn.lock", "webpack.config.js", "gulpfile.js",
    ],
    "typescript": ["tsconfig.json", "tslint.json", "angular.json"],
    "java": ["pom.xml", "build.gradle", "gradle.properties", "build.xml", "ivy.xml"],
    "cpp": ["CMakeLists.txt", "Makefile", "configure.ac", "meson.build", "vcpkg.json"],
    "c": ["Makefile", "configure.ac", "meson.build"],
    "php": ["composer.json", "composer.lock"],
    "ruby": ["Gemfile", "Gemfile.lock", "Rakefile"],
    "go": ["go.mod", "go.sum", "Gopkg.toml"],
    "rust": ["Cargo.toml", "Cargo.lock"],
    "csharp": ["*.csproj", "*.sln", "packages.config"],
}
INDICATOR_POINTS = 3
GLOB_INDICATOR_POINTS = 2

# --- inventory defaults -------------------------------------------------------
INCLUDED_EXTENSIONS = [".py", ".pyw"]
EXCLUDED_PARTS = [
    "__pycache__", ".git", ".svn", "node_modules", ".idea", ".vscode",
    "venv", "env", ".env", "build", "dist", ".pytest_cache",
]
EXCLUDED_BY_LANGUAGE = {
    "python": ["__pycache__", ".pytest_cache", "venv", "env"],
    "javascript": ["node_modules", "dist", "build"],
    "java": ["target", "build", ".gradle"],
    "cpp": ["build", "cmake-build-debug", "cmake-build-release"],
    "c": ["build", "cmake-build-debug", "cmake-build-release"],
}
EXCLUDED_FILE_PATTERNS = [
    "*.pyc", "*.pyo", "*.log", "*.tmp", "*.bak", "*.swp", "*.swo", "*.DS_Store", "Thumbs.db",
]
EXCLUDED_SUFFIXES = [".min.js", ".min.css", ".map"]

# --- job options: name -> (low, high, default, unit, setting key) ----------------
OPTION_BOUNDS = {
    "max_file_size_mb": (0.1, 100.0, 10.0, "MB", "analysis.max_file_size_mb"),
    "max_depth": (1, 20, 10, "níveis", "analysis.max_depth"),
    "timeout_seconds": (10, 3600, 300, "segundos", "analysis.timeout_seconds"),
    "max_workers": (1, 16, 4, "workers", "analysis.max_workers"),
    "min_confidence": (0.0, 1.0, 0.7, "confiança", "rules.min_confidence"),
}
# The default settings by section.
DEFAULT_SETTINGS = {
    "analysis": {"max_file_size_mb": 10.0, "max_depth": 10, "timeout_seconds": 300, "parallel_analysis": True, "max_workers": 4},
    "reports": {
        "default_format": "console", "include_code_snippets": True, "max_snippet_lines": 5, "show_file_stats": True, "color_output": True,
    },
    "rules": {"enabled_severities": ["CRITICAL", "HIGH", "MEDIUM", "LOW"], "disabled_rules": [], "min_confidence": 0.7},
}
DEFAULT_ENABLED_SEVERITIES = ["CRITICAL", "HIGH", "MEDIUM", "LOW"]

# --- syntax detector vocabularies -----------------------------------------------
DANGEROUS_FUNCTIONS = ["eval", "exec", "compile", "__import__"]
SYSTEM_CALLS = [
    "os.system", "subprocess.call", "subprocess.run", "subprocess.Popen", "commands.getoutput",
]
SQL_NAME_PARTS = ["execute", "executemany", "query"]
TAINT_SOURCES = [
    "input", "raw_input", "request.form", "request.args", "request.json", "request.data",
]
SQL_VERBS = ["SELECT", "INSERT", "UPDATE", "DELETE"]
INPUT_LINE = r"\s*(\w+)\s*=\s*input\s*\("
SECRET_NAMES = [
    r"(?i)(password|pwd|passwd|secret|key|token|api_key)",
    r"(?i)(auth|credential|login)",
]
# String content checks; the first one that matches wins.
SECRET_STRINGS = [
    ("API_KEY", r"""(?i)api[_-]?key[_-]?[:=]\s*["']([a-zA-Z0-9]{20,})["']"""),
    ("PASSWORD", r"""(?i)password[_-]?[:=]\s*["']([^"']{6,})["']"""),
    ("SECRET", r"""(?i)secret[_-]?[:=]\s*["']([a-zA-Z0-9]{16,})["']"""),
    ("TOKEN", r"""(?i)token[_-]?[:=]\s*["']([a-zA-Z0-9]{20,})["']"""),
]

# --- message texts (printf style, %s is filled in) ----------------------------------
MSG_DANGEROUS = "Uso de função perigosa '%s()' detectado"
MSG_COMMAND = "Potencial command injection em '%s'"
MSG_SQL = "Potencial SQL injection em '%s' - uso de concatenação ou dados não confiáveis"
MSG_SECRET_NAME = "Possível hardcoded secret na variável '%s'"
MSG_SECRET_STRING = "Possível %s hardcoded detectado"
MSG_SYNTAX = "Erro de sintaxe impede análise AST: %s"
MSG_ANALYSIS_ERROR = "Erro durante análise: %s"
MSG_OVERSIZE = "Arquivo muito grande (%s bytes)"
MSG_OPTION_LOW = "%s muito abaixo do mínimo permitido, ajustado para %s %s"
MSG_OPTION_HIGH = "%s ultrapassou o limite, limitado a %s %s"
MSG_DUPLICATE_ID = "ID duplicado: %s"
MSG_NO_PATTERNS = "Regra %s não tem patterns"
MSG_NO_CWE = "Regra %s não tem CWE ID"
CSV_HEADER = ["Arquivo", "Linha", "Severidade", "Regra", "Mensagem"]

# --- score classes: label per class -----------------------------------------------
SCORE_LABELS = {
    "clean": "Código limpo - sem vulnerabilidades",
    "excellent": "Excelente - código minimamente vulnerável",
    "good": "Bom - código precisa de revisão de segurança",
    "poor": "Ruim - é necessário um refatoramento do código e medidas de segurança à serem tomadas",
    "critical": "Crítico!!!",
}
GATE_HIGH_LIMIT = 5
REPORT_VERSION = "1.0.0"

# Rule families that a vulnerable project is expected to trigger.
EXPECTED_FAMILIES = ["SQL_INJECTION", "HARDCODED", "COMMAND_INJECTION", "DANGEROUS_FUNCTION"]

# Reasons for which a file is not analyzed.
FILE_ERRORS = ["file_too_large", "unreadable", "syntax_aborted", "analysis_error"]
