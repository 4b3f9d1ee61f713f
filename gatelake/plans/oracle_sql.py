"""SQL fragments shared by the checking queries (patterns in RE2 syntax)."""

WS = (
    r"[\t-\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
NON_WS = WS.replace("[", "[^", 1)
COMMENT = (
    r"""(?sm)(''[^\\'']*(?:\\.[^\\'']*)*''|"[^\\"]*(?:\\.[^\\"]*)*")|//.*?$|/\*.*?\*/"""
)
IDENT = r"[A-Za-z_][\w$]*"
MODULE = rf"\bmodule\s+{IDENT}[\s\S]*?endmodule"
MODULE_OR_COMMENT = rf"//[^\n]*|/\*[\s\S]*?\*/|{MODULE}"
INSTANCE_HEAD = rf"\b({IDENT})(?:\s*#\s*\(|\s+{IDENT}\s*(?:\[[^\]]*\]\s*)?\()"


def strip_comments(text: str) -> str:
    return f"regexp_replace({text}, '{COMMENT}', '\\1 ', 'g')"


def extracted(files: str = "hdl_files") -> str:
    """CTE body: one row per module of comment-free text."""
    return (
        f"SELECT dataset_name, design_name, file_name, unnest(regexp_extract_all({strip_comments('text')}, "
        f"'{MODULE}')) AS body FROM {files}"
    )


HASHES = (
    "SELECT sha256(regexp_replace(body, '" + WS + "+', '', 'g')) AS module_hash, "
    "regexp_extract(body, '^module\\s+([A-Za-z_][\\w$]*)', 1) AS module_name, design_name, dataset_name FROM extracted"
)
