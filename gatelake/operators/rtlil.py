"""Processes, ports and connections of flattened netlist text; clock candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatelake.functions import patterns as P
from gatelake.functions import text as X
from gatelake.operators.graph import trace
from gatelake.session import materialize

D = "design_name"


def parse_syncs(texts: DataFrame) -> DataFrame:
    """``(design_name, signal, process, edge)`` of every sync edge inside a process block."""
    t = F.col("rtlil")
    blocks = F.arrays_zip(
        X.find_all(t, P.RTLIL_PROCESS, 1).alias("process"), X.find_all(t, P.RTLIL_PROCESS, 2).alias("body"))
    per_block = texts.select(D, F.explode(blocks).alias("b")).select(D, F.trim("b.process").alias("process"), F.col("b.body").alias("body"))
    b = F.col("body")
    edges = F.arrays_zip(X.find_all(b, P.RTLIL_SYNC, 1).alias("edge"), X.find_all(b, P.RTLIL_SYNC, 2).alias("signal"))
    return per_block.select(D, "process", F.explode(edges).alias("e")).select(D, "e.signal", "process", "e.edge")


def parse_ports(texts: DataFrame) -> DataFrame:
    """``(design_name, direction, name, msb, lsb, width, is_single_bit)``; ``inout`` lines are skipped."""
    line = texts.select(D, F.explode(F.split("portlist", "\n")).alias("l")).select(D, F.trim("l").alias("l")).filter(
        F.col("l").rlike(P.PORT_LINE))

    def part(i):
        return F.regexp_extract("l", P.PORT_LINE, i)

    return line.select(
        D, part(1).alias("direction"), part(4).alias("name"), part(2).cast("int").alias("msb"), part(3).cast("int").alias("lsb")
    ).select(
        "*", F.concat(F.lit("["), "msb", F.lit(":"), "lsb", F.lit("]")).alias("width"), (F.col("msb") == F.col("lsb")).alias("is_single_bit"))


def parse_connections(texts: DataFrame) -> DataFrame:
    """``(design_name, source, target)`` of every plain-name connect statement."""
    t = F.col("rtlil")
    pairs = F.arrays_zip(
        X.find_all(t, P.RTLIL_CONNECT, 2).alias("source"), X.find_all(t, P.RTLIL_CONNECT, 1).alias("target"))
    return texts.select(D, F.explode(pairs).alias("c")).select(D, "c.source", "c.target")


def single_bit_inputs(ports: DataFrame) -> DataFrame:
    return ports.filter((F.col("direction") == "input") & F.col("is_single_bit"))


def ports_reaching_sync(traced: DataFrame, syncs: DataFrame) -> DataFrame:
    """``(design_name, port)`` of ports whose traced signals include a sync signal."""
    named = syncs.select(D, F.regexp_replace("signal", r"^\\", "").alias("signal"))
    return traced.join(named, [D, "signal"], "left_semi").select(D, "port").distinct()


def clock_items(texts: DataFrame) -> DataFrame:
    """``(design_name, kind, a, b)``: what clock detection needs of a dump, from one reading of it.

    ``port``: single-bit inputs ``a`` whose names may be clocks; ``connection``: from
    ``a`` to ``b``; ``sync``: signals ``a`` of sync edges inside processes. A dump
    without such a port gives no rows at all. Narrow.
    """
    t = F.col("rtlil")

    def item(kind: str, a: Column, b: Column | None = None) -> Column:
        return F.struct(F.lit(kind).alias("kind"), a.alias("a"), (b if b is not None else F.lit(None).cast("string")).alias("b"))

    def part(x: Column, i: int) -> Column:
        return F.regexp_extract(x, P.PORT_LINE, i)

    lines = F.transform(F.split("portlist", "\n"), lambda x: F.trim(x))
    inputs = F.filter(lines, lambda x: x.rlike(P.PORT_LINE) & (part(x, 1) == "input") & (part(x, 2).cast("int") == part(x, 3).cast("int")))
    ports = F.filter(F.transform(inputs, lambda x: item("port", part(x, 4))), lambda p: X.clock_like(p["a"]))
    pairs = F.arrays_zip(X.find_all(t, P.RTLIL_CONNECT, 2).alias("a"), X.find_all(t, P.RTLIL_CONNECT, 1).alias("b"))
    connections = F.transform(pairs, lambda p: item("connection", p["a"], p["b"]))
    syncs = F.transform(
        F.flatten(F.transform(X.find_all(t, P.RTLIL_PROCESS, 2), lambda body: X.find_all(body, P.RTLIL_SYNC, 2))),
        lambda s: item("sync", F.regexp_replace(s, r"^\\", "")))
    found = texts.select(D, ports.alias("ports"), "rtlil").where(F.size("ports") > 0)
    return found.select(D, F.explode(F.concat("ports", connections, F.array_distinct(syncs))).alias("i")).select(D, "i.*")


def clock_candidates(texts: DataFrame) -> DataFrame:
    """``(design_name, candidate)`` from ``texts(design_name, rtlil, portlist)``, for all designs in one job.

    Dumps are read once, into a written table of typed items. Only likely clocks are
    start nodes, and a design without any leaves no connections to follow.
    """
    items = materialize(clock_items(texts), "clock_items", apart="kind")
    kind = lambda k: items.where(F.col("kind") == k)
    traced = trace(kind("connection").select(D, F.col("a").alias("source"), F.col("b").alias("target")), kind("port").select(D, F.col("a").alias("name")))
    syncs = kind("sync").select(D, F.col("a").alias("signal"))
    return traced.join(syncs, [D, "signal"], "left_semi").select(D, F.col("port").alias("candidate")).distinct()
