"""The two regular-expression rule packs.

Results depend on every pattern, its place in its list and the place of its rule
in the pack, so both are stated as plain text in their natural order.
"""

# Line patterns that always run, before any rule pack. All are case-insensitive.
BUILTIN_PATTERNS = [
    {
        "id": "SQL_INJECTION_REGEX",
        "severity": "HIGH",
        "category": "injection",
        "message": "Possível SQL injection detectado via regex",
        "patterns": [
            r"""(?:execute|query)\s*\(\s*["'][^"']*["']?\s*\+""",
            r"""(?:execute|query)\s*\(\s*f["'][^"']*\{[^}]+\}""",
            r"""cursor\.execute\s*\(\s*["'][^"']*["']?\s*\+""",
            r"""cursor\.execute\s*\(\s*[^"']*\+""",
            r"""SELECT\s+.*\+.*FROM""",
            r"""INSERT\s+.*\+.*VALUES""",
            r"""UPDATE\s+.*SET.*\+""",
            r"""DELETE\s+.*WHERE.*\+""",
        ],
    },
    {
        "id": "COMMAND_INJECTION_REGEX",
        "severity": "CRITICAL",
        "category": "injection",
        "message": "Possível command injection detectado via regex",
        "patterns": [
            r"""os\.system\s*\(\s*["'][^"']*["']?\s*\+""",
            r"""subprocess\.(call|run|Popen)\s*\(\s*["'][^"']*["']?\s*\+""",
            r"""os\.popen\s*\(\s*["'][^"']*["']?\s*\+""",
            r"""shell=True.*\+""",
        ],
    },
    {
        "id": "HARDCODED_SECRETS_REGEX",
        "severity": "MEDIUM",
        "category": "hardcoded_secrets",
        "message": "Possível credencial hardcoded detectada via regex",
        "patterns": [
            r"""(?i)password\s*=\s*["'][^"']{6,}["']""",
            r"""(?i)api[_-]?key\s*=\s*["'][^"']{10,}["']""",
            r"""(?i)secret[_-]?key\s*=\s*["'][^"']{10,}["']""",
            r"""(?i)token\s*=\s*["'][^"']{20,}["']""",
            r"""(?i)auth[_-]?token\s*=\s*["'][^"']{15,}["']""",
        ],
    },
]

# Defaults of a rule that leaves a field out.
RULE_DEFAULTS = {
    "case_sensitive": True,
    "multiline": False,
    "enabled": True,
    "confidence_threshold": 0.5,
}

# The shipped rule pack.
SHIPPED_RULES = [
    {
        "id": "SQL_INJECTION_001",
        "name": "SQL Injection - String Concatenation",
        "description": "Detecta potencial SQL injection através de concatenação de strings em queries",
        "severity": "HIGH",
        "category": "injection",
        "rule_type": "regex",
        "patterns": [
            r"""(?:SELECT|INSERT|UPDATE|DELETE).*\+.*(?:WHERE|VALUES|SET)""",
            r"""cursor\.execute\s*\(\s*["'][^"']*["']\s*\+""",
            r"""\.format\s*\([^)]*\)\s*(?:SELECT|INSERT|UPDATE|DELETE)""",
            r"""f["'].*(?:SELECT|INSERT|UPDATE|DELETE).*\{.*\}.*["']""",
        ],
        "target_languages": ["python"],
        "file_patterns": ["*.py"],
        "excluded_paths": ["test", "tests"],
        "case_sensitive": False,
        "confidence_threshold": 0.7,
        "cwe_id": "CWE-89",
        "owasp_category": "A03:2021 - Injection",
        "references": [
            "https://owasp.org/www-community/attacks/SQL_Injection",
            "https://cwe.mitre.org/data/definitions/89.html",
        ],
        "tags": ["sql", "injection", "database"],
    },
    {
        "id": "XSS_001",
        "name": "Cross-Site Scripting (XSS)",
        "description": "Detecta potencial vulnerabilidade XSS em templates e outputs",
        "severity": "MEDIUM",
        "category": "xss",
        "rule_type": "regex",
        "patterns": [
            r"""innerHTML\s*=\s*.*\+""",
            r"""document\.write\s*\(\s*.*\+""",
            r"""\.html\(\s*.*\+""",
            r"""render_template_string\s*\(""",
            r"""\|\s*safe(?:\s*\}|$)""",
        ],
        "target_languages": ["javascript", "python"],
        "file_patterns": ["*.js", "*.html", "*.py"],
        "excluded_paths": ["test", "tests"],
        "case_sensitive": False,
        "confidence_threshold": 0.6,
        "cwe_id": "CWE-79",
        "owasp_category": "A03:2021 - Injection",
        "references": [
            "https://owasp.org/www-community/attacks/xss/",
            "https://cwe.mitre.org/data/definitions/79.html",
        ],
        "tags": ["xss", "injection", "web"],
    },
    {
        "id": "HARDCODED_SECRETS_001",
        "name": "Hardcoded Secrets",
        "description": "Detecta segredos hardcoded no código",
        "severity": "HIGH",
        "category": "hardcoded_secrets",
        "rule_type": "regex",
        "patterns": [
            r"""(?:password|pwd|passwd)\s*=\s*["'][^"']{3,}["']""",
            r"""(?:api_key|apikey|secret_key|secretkey)\s*=\s*["'][^"']{10,}["']""",
            r"""(?:token|auth_token|access_token)\s*=\s*["'][^"']{10,}["']""",
            r"""(?:private_key|privatekey)\s*=\s*["'][^"']{20,}["']""",
        ],
        "target_languages": ["python", "javascript", "java"],
        "file_patterns": ["*.py", "*.js", "*.java"],
        "excluded_paths": ["test", "tests"],
        "case_sensitive": False,
        "confidence_threshold": 0.8,
        "cwe_id": "CWE-798",
        "owasp_category": "A07:2021 - Identification and Authentication Failures",
        "references": ["https://cwe.mitre.org/data/definitions/798.html"],
        "tags": ["secrets", "credentials", "authentication"],
    },
    {
        "id": "DANGEROUS_FUNCTIONS_001",
        "name": "Dangerous Functions",
        "description": "Detecta uso de funções perigosas como eval() e exec()",
        "severity": "HIGH",
        "category": "dangerous_functions",
        "rule_type": "ast",
        "patterns": ["dangerous_functions"],
        "target_languages": ["python"],
        "file_patterns": ["*.py"],
        "excluded_paths": ["test", "tests"],
        "case_sensitive": True,
        "confidence_threshold": 0.9,
        "cwe_id": "CWE-95",
        "owasp_category": "A03:2021 - Injection",
        "references": ["https://cwe.mitre.org/data/definitions/95.html"],
        "tags": ["eval", "exec", "code_injection"],
    },
    {
        "id": "BROKEN_AUTH_001",
        "name": "Weak Password Validation",
        "description": "Detecta validação de senha fraca ou ausente",
        "severity": "MEDIUM",
        "category": "broken_authentication",
        "rule_type": "regex",
        "patterns": [
            r"""password.*=.*input""",
            r"""if.*password.*==""",
            r"""password.*length.*<.*[1-5]""",
            r"""no.*password.*validation""",
        ],
        "target_languages": ["python", "javascript"],
        "file_patterns": ["*.py", "*.js"],
        "excluded_paths": ["test", "tests"],
        "case_sensitive": False,
        "confidence_threshold": 0.6,
        "cwe_id": "CWE-521",
        "owasp_category": "A07:2021 - Identification and Authentication Failures",
        "references": [
            "https://cwe.mitre.org/data/definitions/521.html",
            "https://owasp.org/www-project-top-ten/2017/A2_2017-Broken_Authentication",
        ],
        "tags": ["authentication", "password", "validation"],
    },
    {
        "id": "SEC_MISCONFIG_001",
        "name": "Debug Mode Enabled",
        "description": "Detecta modo debug habilitado em produção",
        "severity": "HIGH",
        "category": "security_misconfiguration",
        "rule_type": "regex",
        "patterns": [
            r"""DEBUG.*=.*True""",
            r"""debug.*:.*true""",
            r"""app\.debug.*=.*True""",
            r"""development.*mode.*true""",
        ],
        "target_languages": ["python", "javascript"],
        "file_patterns": ["*.py", "*.js", "*.json", "*.yaml", "*.yml"],
        "excluded_paths": ["test", "tests", "development"],
        "case_sensitive": False,
        "confidence_threshold": 0.8,
        "cwe_id": "CWE-489",
        "owasp_category": "A05:2021 - Security Misconfiguration",
        "references": ["https://cwe.mitre.org/data/definitions/489.html"],
        "tags": ["debug", "configuration", "production"],
    },
    {
        "id": "CRYPTO_WEAK_001",
        "name": "Weak Cryptographic Algorithm",
        "description": "Detecta uso de algoritmos criptográficos fracos",
        "severity": "HIGH",
        "category": "cryptography",
        "rule_type": "regex",
        "patterns": [
            r"""hashlib\.md5""",
            r"""hashlib\.sha1""",
            r"""Crypto\.Hash\.MD5""",
            r"""CryptoJS\.MD5""",
            r"""algorithm.*['"]DES['"]""",
            r"""algorithm.*['"]RC4['"]""",
        ],
        "target_languages": ["python", "javascript"],
        "file_patterns": ["*.py", "*.js"],
        "excluded_paths": ["test", "tests"],
        "case_sensitive": False,
        "confidence_threshold": 0.9,
        "cwe_id": "CWE-327",
        "owasp_category": "A02:2021 - Cryptographic Failures",
        "references": ["https://cwe.mitre.org/data/definitions/327.html"],
        "tags": ["cryptography", "hash", "weak", "algorithm"],
    },
    {
        "id": "INJECTION_CMD_001",
        "name": "Command Injection",
        "description": "Detecta potencial injeção de comandos do sistema",
        "severity": "CRITICAL",
        "category": "injection",
        "rule_type": "regex",
        "patterns": [
            r"""os\.system\s*\(.*\+""",
            r"""subprocess\.call\s*\(.*\+""",
            r"""subprocess\.run\s*\(.*\+""",
            r"""exec\s*\(.*\+""",
            r"""shell=True.*\+""",
            r"""cmd.*=.*input.*\+.*command""",
        ],
        "target_languages": ["python"],
        "file_patterns": ["*.py"],
        "excluded_paths": ["test", "tests"],
        "case_sensitive": False,
        "confidence_threshold": 0.7,
        "cwe_id": "CWE-78",
        "owasp_category": "A03:2021 - Injection",
        "references": [
            "https://cwe.mitre.org/data/definitions/78.html",
            "https://owasp.org/www-community/attacks/Command_Injection",
        ],
        "tags": ["command", "injection", "os", "subprocess"],
    },
]
SHIPPED_DATE = "2025-01-01"
