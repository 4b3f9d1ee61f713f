"""Explicit schemas of the tables the library reads and writes."""

from pyspark.sql import types as T


def _s(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in cols])


STR, LONG, INT = T.StringType(), T.LongType(), T.IntegerType()

DESIGNS = _s(("design_name", STR), ("dataset_name", STR), ("dataset_tags", T.ArrayType(STR)))

FILES = _s(("dataset_name", STR), ("design_name", STR), ("file_name", STR), ("role", STR), ("text", STR))

MEMBERS = _s(
    ("dataset_name", STR), ("archive", STR), ("path", STR), ("content", T.BinaryType()), ("load_seq", LONG)
)

CONNECTIVITY = _s(
    ("module_name", STR),
    ("cell_name", STR),
    ("cell_type", STR),
    ("cell_port", STR),
    ("direction", STR),
    ("signal", STR),
)

NETLIST_JSON = T.StructType().add(
    "modules",
    T.MapType(
        STR,
        T.StructType()
        .add("attributes", T.MapType(STR, STR))
        .add("cells", T.MapType(STR, T.StructType().add("type", STR))),
    ),
)

AST_NODES = _s(
    ("design_name", STR),
    ("file_name", STR),
    ("idx", INT),
    ("parent_idx", INT),
    ("depth", INT),
    ("tag", STR),
    ("attrs", STR),
    ("status", STR),
)

REPO_PAGE = T.StructType().add(
    "items",
    T.ArrayType(T.StructType().add("id", LONG).add("full_name", STR).add("html_url", STR)),
)

REPO_INDEX = _s(("id", LONG), ("full_name", STR), ("html_url", STR))
