"""Source rules: which members of a source make which design.

A source is a list of rules over member paths. Rules are data; applying them
is one narrow projection (pattern per rule compiled once), so millions of
members are mapped to designs without a join.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatelake.functions import patterns as P
from gatelake.functions import text as X
from gatelake.operators import repair
from gatelake.sources.catalog import last_written


@dataclass(frozen=True)
class Rule:
    """Members whose path matches ``path`` belong to design ``prefix + sep + base``.

    ``base`` is a replacement over the whole match. ``exclude`` tests the raw
    base name; with ``exclude_as="substring_of"`` a base that is contained in
    the word is excluded. ``translate`` and ``upper`` then clean the name.
    """

    dataset: str
    path: str
    base: str = "$1"
    prefix: str | None = None
    sep: str = "__"
    translate: tuple[str, str] = ("", "")
    remove: tuple[str, ...] = ()
    upper: bool = False
    exclude: tuple[str, ...] = ()
    exclude_as: str = "equals"
    skip: str | None = None
    role: str | None = "verilog"
    classify: bool = False
    file_name: str | None = None
    nested: bool = False
    base_map: dict[str, str] = field(default_factory=dict, hash=False)
    tags: tuple[str, ...] = ("benchmark",)


# --- fixed values: tags per source -------------------------------------------------
TAGS = {
    "opencores": ("open_source",),
    "verilog_adders_mongrelgem": ("open_source",),
    "regex_fsm_verilog": ("synthetic",),
    "xact": ("benchmark", "reference"),
    "espresso_pla": ("benchmark", "reference"),
    "polybench": ("hls",),
}

# --- fixed values: listed files and directories ------------------------------------
ADDER_FILES = [
    "Carry Lookahead Adder/CarryLookaheadAdder.v",
    "Carry Ripple Adder/CarryRippleAdder.v",
    "Carry Select Adder/CarrySelectAdder.v",
    "Carry Skip Adder/CarrySkipAdder.v",
    "Hybrid Adder/HybridAdder.v",
    "Kogge-Stone Adder/KoggeStoneAdder.v",
]
DEEPBENCH_DIRS = [
    "verilog/inference/Conv/conv_b1_in_112_112_3_f_7_7_16_s_2_p_same/ap_fixed_16_8",
    "verilog/inference/Conv/conv_b1_in_112_112_3_f_7_7_16_s_2_p_same/ap_fixed_8_4",
    "verilog/inference/Conv/conv_b1_in_56_56_16_f_1_1_64_s_2_p_valid/ap_fixed_16_8",
    "verilog/inference/Conv/conv_b1_in_56_56_16_f_1_1_64_s_2_p_valid/ap_fixed_8_4",
    "verilog/inference/Conv/conv_b2_in_7_7_32_f_1_1_128_s_1_p_valid/ap_fixed_16_8",
    "verilog/inference/Conv/conv_b2_in_7_7_32_f_1_1_128_s_1_p_valid/ap_fixed_8_4",
    "verilog/inference/GEMM/GEMM_3072_3000_1024_N_N_Core_256_200_256",
    "verilog/inference/GEMM/GEMM_35_700_2048_N_N_Core_35_175_256",
    "verilog/inference/GEMM/GEMM_5124_700_2048_N_N_Core_244_175_256",
    "verilog/inference/GEMM/GEMM_512_6000_2816_N_N_Core_256_200_256",
    "verilog/inference/RNN/LSTM_256_4_Core_256_4_256_Reuse_4_1_2",
    "verilog/inference/RNN/LSTM_1536_4_Core_256_4_256_Reuse_24_1_12",
    "verilog/inference/RNN/GRU_2560_2_Core_256_2_256_Reuse_30_1_20",
    "verilog/inference/RNN/GRU_2816_1_Core_256_1_256_Reuse_33_1_22",
    "verilog/training/Conv/conv_b16_in_28_28_16_f_5_5_8_s_1_p_same",
    "verilog/training/Conv/conv_b16_in_56_56_3_f_3_3_16_s_1_p_same",
    "verilog/training/Conv/conv_b16_in_7_7_16_f_3_3_16_s_1_p_same",
    "verilog/training/Conv/conv_b8_in_28_28_16_f_3_3_16_s_1_p_same",
    "verilog/training/GEMM/GEMM_1760_128_1760_N_N_Core_220_128_220",
    "verilog/training/GEMM/GEMM_1760_128_1760_N_N_Core_352_128_352_extra",
    "verilog/training/GEMM/GEMM_2560_64_2560_N_N_Core_256_64_256",
    "verilog/training/GEMM/GEMM_3072_128_1024_T_N_Core_256_128_256",
    "verilog/training/GEMM/GEMM_5124_9124_2560_T_N_Core_244_256_256",
    "verilog/training/GEMM/GEMM_7860_648_2560_N_N_Core_131_64_256",
    "verilog/training/RNN/LSTM_1024_128_Core_256_128_256_Reuse_16_1_8",
    "verilog/training/RNN/LSTM_2816_32_Core_256_32_256_Reuse_33_1_22",
    "verilog/training/RNN/Vanilla_1760_16_Core_220_16_220_Reuse_8_1_12",
    "verilog/training/RNN/Vanilla_2560_32_Core_256_32_256_Reuse_10_1_20",
]
MICRO_FILES = [
    "simple_registers/signal_gen/clock_divider.v",
    "simple_registers/signal_gen/pulse_generator.v",
    "simple_registers/signal_gen/reset_generator.v",
    "ram/pipelined_8bit_adder/pipelined_8bit_adder.v",
]
MICRO_GROUPS = {
    "FSM_three_code": [
        "fsm/FSM_three_code/FSM_hour.v",
        "fsm/FSM_three_code/FSM_minute.v",
        "fsm/FSM_three_code/FSM_second.v",
        "fsm/FSM_three_code/FSM_top.v",
    ],
}
MICRO_COLLECTIONS = ["simple_registers/counters", "dsp/mac"]
# --- fixed values: directories of the small-design source, exceptions to their names, and files of other sources ---
# directory → design; the name is the directory with "/" as "_", minus a trailing rtl part
MICRO_DIRS = [
    "simple_registers/blinking", "simple_registers/clk_divider", "simple_registers/ff/dffnr",
    "simple_registers/pwm_generator", "simple_gates/and2", "simple_gates/and2_latch",
    "simple_gates/and2_latch_2clock", "simple_gates/and2_or2", "simple_gates/and2_pipelined",
    "simple_gates/and4", "simple_gates/or2", "ram/asyn_spram_4x1", "ram/dual_port_ram_16k",
    "ram/dual_port_ram_1k", "ram/fifo/rtl", "ram/syn_spram_4x1", "processors/VexRiscv_full/rtl",
    "processors/VexRiscv_murax/rtl", "processors/VexRiscv_small/rtl", "interface/SAPone/rtl",
    "interface/cf_ldpc/rtl", "interface/opencores_can/rtl/verilog", "interface/opencores_gpio/rtl",
    "interface/opencores_i2c/rtl", "interface/opencores_ptc/rtl", "interface/opencores_simple_spi/rtl",
    "interface/opencores_uart16550/rtl", "interface/routing_test", "interface/rtcclock/rtl",
    "interface/sockit_owm/rtl", "interface/spimaster/rtl", "interface/test_mode_low",
    "interface/test_modes/k4_N4", "interface/test_modes/k6_N10", "interface/uberddr3/rtl",
    "interface/verilog_spi/rtl", "interface/wb_lcd/rtl", "interface/wb_lcd_ramless/rtl",
    "interface/wb_rs232_syscon/rtl", "interface/wbi2c", "interface/wbqspiflash/rtl",
    "interface/wbscope/rtl", "interface/wbspi_master/rtl", "interface/wbuart32/rtl",
    "fsm/fsm_seq_detector", "fsm/scalable_seq_detector", "dsp/FIR_filter", "dsp/cordic/rtl",
    "dsp/cordic_core", "dsp/cr_div/rtl", "dsp/mult/mult_2_pipelined", "dsp/pid_controller/rtl",
    "dsp/signed_integer_divider/rtl", "simple_gates/adder/adder_4", "simple_gates/adder/adder_6",
    "simple_gates/adder/adder_16",
]
# directories whose design name does not follow from the path
MICRO_DIR_NAMES = {
    "interface/opencores_can/rtl/verilog": "interface_opencores_can",
    "simple_gates/adder/adder_4": "simple_gates_adder_4",
    "simple_gates/adder/adder_6": "simple_gates_adder_6",
    "simple_gates/adder/adder_16": "simple_gates_adder_16",
}
MCNC_MISSING_END = ["i10", "i2", "i3", "i4", "i5", "i6", "i7"]
SHARED_FILES = {
    "vtr": ["vtr_flow/primitives.v"],
    "iscas89": ["Verilog/lib.v", "Verilog/DFF2.v"],
}


def _any_of(paths: list[str]) -> str:
    return "|".join(r"\Q" + p + r"\E" for p in paths)


def _micro_dir_name(directory: str) -> str:
    return MICRO_DIR_NAMES.get(directory, directory.removesuffix("/rtl").replace("/", "_"))


_BY_EXT = r"\.(?:" + "|".join(P.VERILOG_EXTENSIONS_ANY + P.DATA_EXTENSIONS_ANY) + ")"

RULES: list[Rule] = [
    Rule("opencores", r"^designs/([^/]+)/.*$", exclude=("6809_6309_compatible_core",), classify=True),
    Rule("hw_2_vec", r"^(?:.*/)?([^/]+)/[^/]+\.v$", prefix="hw2vec", translate=("-", "_"),
         exclude=("RS232-T100",), exclude_as="substring_of"),
    Rule("vtr", r"^vtr_flow/benchmarks/verilog/([^/]+)\.v$",
         exclude=("LU8PEEng", "LU32PEEng", "LU64PEEng", "boundtop", "mcml")),
    Rule("koios", r"^vtr_flow/benchmarks/verilog/koios/([^/]+)\.v$", skip=r"_include\.v"),
    Rule("epfl", r"^(?:arithmetic|random_control)/([^/]+)\.v$"),
    Rule("opdb", r"^[^/]+/(.+)$", translate=("/", "_"), remove=(".v", ".pickle"), file_name="{base}.v"),
    Rule("iscas85", r"^Verilog/(c.*?)\.v$", upper=True),
    Rule("iscas89", r"^Verilog/(s.*?)\.v$", upper=True),
    Rule("lgsynth89", r"^LGSynth89/Verilog/(?:.*/)?([^/]*?)_orig\.v$"),
    Rule("lgsynth91", r"^LGSynth91/Verilog/.*?/(?:.*/)?([^/]*?)_orig\.v$", translate=(".", "_")),
    Rule("iwls93", r"^blif/(?:.*/)?([^/]*?)\.blif$", exclude=("diffeq", "elliptic", "frisc", "tseng"), role="blif"),
    Rule("i99t", r"^i99t/([^/]+)/\1\.vhd$", sep="_", exclude=("b08", "b30"), role="vhdl", file_name="{base}.vhdl"),
    Rule("adders_cvut", r"^(?:.*/)?([^/]*?)\.blif$", translate=("-", "_"), skip=r"_col\.blif$", role="blif"),
    Rule("verilog_adders_mongrelgem", rf"^(?:{_any_of(ADDER_FILES)})$", base="{stem}"),
    Rule("mcnc20", r"^(?:.*/)?([^/]*?)\.blif$", role="blif"),
    Rule("deepbenchverilog", rf"^(?:{_any_of([d for d in DEEPBENCH_DIRS if 'inference/Conv' in d])})/[^/]+$", base="{parent2}", role=None),
    Rule("deepbenchverilog", rf"^(?:{_any_of([d for d in DEEPBENCH_DIRS if 'inference/Conv' not in d])})/[^/]+$", base="{parent}", role=None),
    Rule("regex_fsm_verilog", r"^generated_designs/([^/]+)/fsm\.v$"),
    Rule("xact", r"^([^/]+)/(?:vlib|\1)\.v$"),
    Rule("xact", r"^([^/]+)/top\.txt$", role="top"),
    Rule("espresso_pla", r"^generated_designs/([^/]+)/\1\.v$"),
    Rule("fpga_micro_benchmarks", rf"^(?:{_any_of(MICRO_FILES)})$", base="{stem}"),
    Rule("fpga_micro_benchmarks", rf"^(?:{_any_of(MICRO_GROUPS['FSM_three_code'])})$", base="FSM_three_code"),
    Rule("fpga_micro_benchmarks", rf"^(?:{_any_of(MICRO_DIRS)})/[^/]+{_BY_EXT}$",
         base="{dir}", base_map={d: _micro_dir_name(d) for d in MICRO_DIRS}, role=None),
    Rule("fpga_micro_benchmarks", rf"^(?:{_any_of(MICRO_COLLECTIONS)})/([^/]+)/[^/]+{_BY_EXT}$",
         skip=r"_tb\.[^./]*$", role=None),
    Rule("polybench", r"^(?:.*/)?hls_polybench__([^_]+)__([^_]+)__build\.tar\.gz!([^/]+)/ip_\3\.zip!hdl/verilog/.*$",
         base="$1__$2__$3", prefix="hls_polybench", translate=("-", "_"), nested=True, role=None),
]


def _base(rule: Rule, path: Column) -> Column:
    parts = F.split(path, "/")
    special = {
        "{stem}": F.regexp_replace(F.element_at(parts, -1), r"\.[^.]*$", ""),
        "{parent}": F.element_at(parts, -2),
        "{parent2}": F.concat_ws("_", F.try_element_at(parts, F.lit(-3)), F.element_at(parts, -2)),
        "{dir}": F.regexp_replace(path, r"/[^/]*$", ""),
    }
    base = special.get(rule.base, F.regexp_replace(path, rule.path, rule.base))
    if rule.base_map:
        pairs = [F.lit(x) for kv in rule.base_map.items() for x in kv]
        base = F.try_element_at(F.create_map(*pairs), base)
    return base


def _match(rule: Rule, dataset: Column, path: Column, full: Column) -> Column:
    """Struct for a member the rule takes, else NULL."""
    subject = full if rule.nested else path
    raw = _base(rule, subject)
    taken = (dataset == rule.dataset) & subject.rlike(rule.path)
    if rule.skip:
        taken &= ~path.rlike(rule.skip)
    if rule.exclude and rule.exclude_as == "equals":
        taken &= ~raw.isin(*rule.exclude)
    for word in rule.exclude if rule.exclude_as == "substring_of" else ():
        taken &= ~F.contains(F.lit(word), raw)
    base = raw
    for piece in rule.remove:
        base = F.replace(base, F.lit(piece), F.lit(""))
    if rule.translate[0]:
        base = F.translate(base, *rule.translate)
    if rule.upper:
        base = F.upper(base)
    name = X.base_name(path)
    if rule.file_name:
        stem = rule.file_name.replace("{base}", "")
        name = F.concat(base, F.lit(stem))
    by_ext = X.file_role(path)
    if rule.classify:
        roles = member_roles(path)
    else:
        # files stored as sources are never side files, whatever their extension
        roles = F.array(F.lit(rule.role) if rule.role else F.when(by_ext == "aux", "data").otherwise(by_ext))
    return F.when(
        taken,
        F.struct(
            F.concat(F.lit((rule.prefix or rule.dataset) + rule.sep), base).alias("design_name"),
            name.alias("file_name"),
            roles.alias("roles"),
        ),
    )


def member_roles(path: Column) -> Column:
    """Roles a member is stored under; ``top.txt`` is kept both as the top and with the other files."""
    role = X.file_role(path)
    return F.when(X.base_name(path) == "top.txt", F.array(F.lit("top"), role)).otherwise(F.array(role))


def classify_members(members: DataFrame) -> DataFrame:
    """One row per member and role."""
    return members.withColumn("role", F.explode(member_roles(F.col("path"))))


def apply_rules(members: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Members with ``design_name, file_name, role`` for every rule that takes them. Narrow."""
    full = F.concat_ws("!", *([F.col("archive")] if "archive" in members.columns else []), "path")
    hits = [_match(r, F.col("dataset_name"), F.col("path"), full) for r in (rules or RULES)]
    hit = F.explode(F.filter(F.array(*hits), lambda h: h.isNotNull()))
    return (
        members.withColumn("_h", hit)
        .select(*members.columns, "_h.design_name", "_h.file_name", F.explode("_h.roles").alias("role"))
    )


def select_listed(members: DataFrame, list_path: str) -> DataFrame:
    """Members named in a list file that is a member itself (one path per line)."""
    listed = members.filter(F.col("path") == list_path).select(
        "dataset_name", F.explode(F.split(X.decode_text(F.col("content")), "\r?\n")).alias("path")
    ).filter(F.trim("path") != "")
    return members.join(listed.distinct(), ["dataset_name", "path"], "left_semi")


# ------------------------------------------------------------------ text repairs per source
REPAIRS: dict[str, Callable[[Column, Column], Column]] = {
    "iwls93": lambda text, name: repair.drop_duplicate_models(repair.fix_constants(text)),
    "mcnc20": lambda text, name: repair.add_global_clock(
        F.when(
            F.regexp_replace(name, r"\.blif$", "").isin(MCNC_MISSING_END), repair.append_end(repair.remove_exdc(text))
        ).otherwise(repair.remove_exdc(text))
    ),
    "verilog_adders_mongrelgem": lambda text, name: repair.unroll_cell_arrays(text),
}


def repaired(files: DataFrame) -> DataFrame:
    """Source-specific repairs; a file that cannot be repaired gets NULL text."""
    text = F.col("text")
    for dataset, fix in REPAIRS.items():
        text = F.when(F.col("dataset_name") == dataset, fix(F.col("text"), F.col("file_name"))).otherwise(text)
    return files.withColumn("text", text)


def attach_shared_files(files: DataFrame, designs: DataFrame, shared: DataFrame) -> DataFrame:
    """Add ``shared(dataset_name, file_name, role, text)`` to every design of its source.

    An equi-join on the source: the planner broadcasts the library files while
    they are below its size threshold and splits skewed sources beyond it.
    """
    extra = designs.select("design_name", "dataset_name").join(shared, "dataset_name")
    return files.unionByName(extra.select(files.columns))


def shared_files(members: DataFrame) -> DataFrame:
    """Library files of the sources that have them; RAM primitives are rewritten."""
    wanted = [
        (F.col("dataset_name") == d) & F.col("path").isin(paths) for d, paths in SHARED_FILES.items()
    ]
    cond = wanted[0]
    for w in wanted[1:]:
        cond |= w
    text = X.normalize_newlines(X.decode_text(F.col("content")))
    return members.filter(cond).select(
        "dataset_name", X.base_name(F.col("path")).alias("file_name"), F.lit("verilog").alias("role"),
        F.when(F.col("dataset_name") == "vtr", X.literal_rewrites(text)).otherwise(text).alias("text"))


class SourcePlugin:
    """A source: its rules, an optional expander for its archives, and optional list file.

    ``load(members)`` gives ``(designs, files)`` ready for the catalogue's
    upsert; ``members`` should be a written table (``materialize``), since
    archives are not worth expanding twice. Subclass or instantiate with other rules for a new source.
    """

    def __init__(self, dataset: str, rules: list[Rule] | None = None, *, list_path: str | None = None,
                 expander: Callable[[DataFrame], DataFrame] | None = None, tags: tuple[str, ...] | None = None) -> None:
        self.dataset = dataset
        self.rules = rules if rules is not None else [r for r in RULES if r.dataset == dataset]
        if not self.rules:
            raise NotImplementedError(f"no rules for source {dataset}")
        self.list_path = list_path
        self.expander = expander
        self.tags = tags or TAGS.get(dataset, ("benchmark",))

    def load(self, members: DataFrame) -> tuple[DataFrame, DataFrame]:
        if self.expander is not None:
            members = members.unionByName(self.expander(members))
        chosen = select_listed(members, self.list_path) if self.list_path else members
        placed = apply_rules(chosen, self.rules)
        text = X.normalize_newlines(X.decode_text(F.col("content")))
        stored = placed.select(
            "dataset_name", "design_name", F.concat_ws("/", "role", "file_name").alias("file_name"), "role",
            text.alias("text"), "archive", "load_seq")
        # the same name twice in one design and role: the later member wins
        files = last_written(stored, ["archive", "load_seq"]).select(
            "dataset_name", "design_name", X.base_name(F.col("file_name")).alias("file_name"), "role", "text")
        designs = placed.select("design_name", "dataset_name").distinct().withColumn(
            "dataset_tags", F.array(*[F.lit(t) for t in self.tags]))
        files = repaired(files)
        if self.dataset in SHARED_FILES:
            files = attach_shared_files(files, designs, shared_files(members))
        if self.dataset == "espresso_pla":
            # the top module carries the design's own name
            files = files.unionByName(designs.select(
                "dataset_name", "design_name", F.lit("top.txt").alias("file_name"), F.lit("top").alias("role"),
                F.regexp_replace("design_name", "^espresso_pla__", "").alias("text")))
        return designs, files


SOURCES: dict[str, Callable[[], SourcePlugin]] = {
    r.dataset: (lambda d=r.dataset: SourcePlugin(d)) for r in RULES
}


def _opdb() -> SourcePlugin:
    return SourcePlugin("opdb", list_path="modules/piton_baseline_designs.txt")


def _polybench() -> SourcePlugin:
    from gatelake.sources.archives import expand_nested

    return SourcePlugin("polybench", expander=expand_nested)


SOURCES["opdb"] = _opdb
SOURCES["polybench"] = _polybench
