"""File extensions, patterns and word lists the results depend on.

Patterns are written for ``java.util.regex``. What runs over whole bodies is the dot
that matches all (``(?s:.*?)``): a class of everything (``[\\s\\S]*?``) takes thirty
times as long, and a repeated group recurses once per iteration in the JVM.
"""

# --- fixed values: accepted extensions (lower-case and all-upper forms only) ---
VERILOG_EXTENSIONS = ["v", "sv", "svh", "vh", "h", "inc"]
DATA_EXTENSIONS = ["coe", "mif", "mem"]
VERILOG_EXTENSIONS_ANY = VERILOG_EXTENSIONS + [e.upper() for e in VERILOG_EXTENSIONS]
DATA_EXTENSIONS_ANY = DATA_EXTENSIONS + [e.upper() for e in DATA_EXTENSIONS]

# --- fixed values: whitespace as Unicode defines it, one class for every engine ---
WS_CLASS = (
    r"\t-\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
WHITESPACE = f"[{WS_CLASS}]+"
NON_WHITESPACE = f"[^{WS_CLASS}]"
ASCII_WHITESPACE = r"[\t-\r\x1C-\x20]+"

# --- fixed values: comment, literal and module patterns ---
COMMENT_OR_LITERAL = (
    r"(?dsm)('[^\\']*+(?:\\.[^\\']*+)*+'"
    r'|"[^\\"]*+(?:\\.[^\\"]*+)*+")'
    r"|//.*?$|/\*.*?\*/"
)
IDENTIFIER = r"[A-Za-z_][\w$]*"
MODULE = rf"\bmodule\s+{IDENTIFIER}(?s:.*?)endmodule"
MODULE_NAME = rf"^module\s+({IDENTIFIER})"
STRICT_HEADER = rf"^module\s+{IDENTIFIER}\s*[(#]"
# comments outside modules are consumed first, so a commented "module" never starts a match
MODULE_OR_COMMENT = rf"//[^\n]*|/\*(?s:.*?)\*/|{MODULE}"
INSTANCE_HEAD = (
    # nothing is given back: what may follow a name or blanks is in neither
    rf"\b({IDENTIFIER}+)(?:\s*+#\s*+\(|\s++{IDENTIFIER}+\s*+(?:\[[^\]]*+\]\s*+)?\()"
)
MODULE_COUNT = r"module\s+\S+(?s:.*?)endmodule"
MODULE_DEFINITION_COUNT = r"module(?s:.*?)endmodule"

# --- fixed values: words that mark an input as reset / enable / ready / valid ---
NON_CLOCK_WORDS = ["rst", "reset", "en", "enable", "rdy", "ready", "vld", "valid"]
NON_CLOCK_NAME = rf"(^|_)({'|'.join(NON_CLOCK_WORDS)})(_|$)"

# --- fixed values: netlist dump patterns ---
RTLIL_PROCESS = r"(?s)process (.*?)\n(.*?)\nend"
RTLIL_SYNC = r"sync (posedge|negedge) (\\\S+)"
RTLIL_CONNECT = r"connect\s+\\(\S+)\s+\\(\S+)"
PORT_LINE = r"^(input|output)\s+\[(\d+):(\d+)\]\s+(\w+)"

# --- fixed values: BLIF repair patterns ---
BLIF_CONSTANT = r"(?dm)(.names +.*? *\n) *([01-]) *$"
BLIF_MODEL = r"(?d)\.model +(.+)(?s:.*?)\.end"
BLIF_EXDC = r"\.exdc(?s:.*?)\.end"
BLIF_LATCH = r"\.latch\s+(\S+)\s+(\S+)\s+([0123])"
CELL_ARRAY_LINE = r"^(\w+) +((?:#\(.*?\) +)*)(\w+)\[(\d+):(\d+)\] *(.*)$"
PORT_RANGE = r"^(\w+)\[(\d+):(\d+)\]$"

# --- fixed values: literal rewrites of the shared RAM primitives ---
PRIMITIVE_REWRITES = [
    ("module single_port_ram", "(* nomem2reg *)\nmodule single_port_ram"),
    ("module dual_port_ram", "(* nomem2reg *)\nmodule dual_port_ram"),
    (
        "reg [DATA_WIDTH-1:0] Mem[MEM_DEPTH-1:0];",
        "(* nomem2reg *) reg [DATA_WIDTH-1:0] Mem[MEM_DEPTH-1:0];",
    ),
]

# --- fixed values: the 100 printable ASCII characters, in this order ---
PRINTABLE = (
    "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~ \t\n\r\x0b\x0c"
)

# --- fixed values: built-in token rules ---
TOKEN_RULES = {
    "word_punct": r"\w+|[^\w\s]",
    # numbers come first, so a word match never starts with a digit
    "hdl": r"\d+(?:'[sS]?[bodhBODH][0-9a-fA-FxXzZ_?]+)?|\w[\w$]*|[^\w$\s]",
}
