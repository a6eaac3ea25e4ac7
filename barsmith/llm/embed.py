"""Near-duplicate embeddings by int8 tile products with rigorous error bounds.

Unit vectors are quantised to int8 with a scale per vector. For a block pair
the integer products of all codes come from one matrix product (exact: the
sums stay below 2^24). With ``x = x' + e`` per vector, the true cosine
differs from the product of the quantised vectors by at most
``|x'| |e_y| + |e_x|``. A pair whose approximate cosine plus this bound
stays below the threshold is no link, one whose approximate cosine less the
bound reaches it is a link, and the pairs between are recomputed from the
original components in double precision.

What travels to the block pairs is the codes, a byte a component. The
original components follow in a second exchange, and only for vectors that
have an undecided pair in that block pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, min_links, roots, stage
from .vectors import deal, matrix, usable

#: Covers the rounding of the bound's own double and single precision steps.
SLACK = 1e-5
#: Components per exact single-precision product: 1024 * 127 * 127 < 2^24.
SPAN = 1024
#: Cells of a strip of a tile that are held at once.
STRIP = 1 << 22

_CODED = "v array<double>, rep long, n long, dim int, code binary, scale double, length double, error double"
_LINKS = "rep long, links long, root long"


class Codes:
    """int8 codes of a block of vectors with each vector's scale, coded length and quantisation error."""

    def __init__(self, code: np.ndarray, scale: np.ndarray, length: np.ndarray, error: np.ndarray):
        self.code, self.scale, self.length, self.error = code, scale, length, error

    @classmethod
    def of(cls, v: np.ndarray) -> Codes:
        unit = v / np.sqrt((v * v).sum(axis=1))[:, None]
        scale = np.abs(unit).max(axis=1) / 127
        code = np.rint(unit / scale[:, None]).astype(np.int8)
        near = code * scale[:, None]
        return cls(code, scale, np.sqrt((near * near).sum(axis=1)), np.sqrt(((unit - near) ** 2).sum(axis=1)))

    @classmethod
    def read(cls, rows: pd.DataFrame) -> Codes:
        code = np.frombuffer(b"".join(rows["code"]), np.int8).reshape(len(rows), -1)
        return cls(code, *(rows[c].to_numpy("float64") for c in ("scale", "length", "error")))

    def __len__(self) -> int:
        return len(self.code)


def levelled(v: np.ndarray) -> np.ndarray:
    """Each vector times a power of two, so that no square leaves the range of doubles; cosines stay the same."""
    return np.ldexp(v, -np.frexp(np.abs(v).max(axis=1))[1][:, None])


def tile(a: Codes, b: Codes, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Strips of index pairs (i of a, j of b) that may reach ``threshold``, and whether it is certain; ``same``: i < j only."""
    step = max(1, STRIP // max(1, len(b)))
    codes = b.code.astype(np.float32)
    for at in range(0, len(a), step):
        to = min(len(a), at + step)
        part = a.code[at:to].astype(np.float32)
        dot = part[:, :SPAN] @ codes[:, :SPAN].T
        for d in range(SPAN, codes.shape[1], SPAN):
            dot = dot + (part[:, d:d + SPAN] @ codes[:, d:d + SPAN].T).astype(np.float64)
        most = a.length[at:to] * b.error.max() + a.error[at:to] + 2 * SLACK  # prefilter: the row's largest bound
        least = ((threshold - most) / a.scale[at:to]).astype(np.float32)
        i, j = np.nonzero(dot * b.scale.astype(np.float32) >= (least - np.abs(least) * np.float32(1e-6))[:, None])
        if same:
            i, j = i[i + at < j], j[i + at < j]
        cosine = dot[i, j].astype(np.float64)
        i = i + at
        cosine *= a.scale[i] * b.scale[j]
        bound = a.length[i] * b.error[j] + a.error[i] + SLACK
        possible = cosine + bound >= threshold
        yield i[possible], j[possible], (cosine - bound >= threshold)[possible]


def reach(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Whether the pairs' cosines in double precision reach ``threshold``."""
    out = np.empty(len(i), bool)
    long_a, long_b = (np.sqrt((v * v).sum(axis=1)) for v in (a, b))
    step = max(1, STRIP // max(1, a.shape[1]))
    for k in range(0, len(i), step):
        x, y = i[k:k + step], j[k:k + step]
        out[k:k + step] = np.einsum("ij,ij->i", a[x], b[y]) / (long_a[x] * long_b[y]) >= threshold
    return out


class _Found:
    """Links of a block pair as they come: the number of rows linked to each class, and a spanning forest."""

    def __init__(self, left: pd.DataFrame, right: pd.DataFrame):
        rep = [side["rep"].to_numpy("int64") for side in (left, right)]
        self.n = [side["n"].to_numpy("float64") for side in (left, right)]
        self.node = np.unique(np.concatenate(rep))
        self.at = [np.searchsorted(self.node, r) for r in rep]
        self.links = np.zeros(len(self.node), np.int64)
        self.parent = np.arange(len(self.node))

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        for at, here, there, n in ((self.at[0], i, j, self.n[1]), (self.at[1], j, i, self.n[0])):
            self.links += np.bincount(at[here], n[there], len(self.node)).astype(np.int64)
        min_links(self.at[0][i], self.at[1][j], self.parent)

    def rows(self) -> pd.DataFrame:
        own = np.flatnonzero(self.links)
        return pd.DataFrame({"rep": self.node[own], "links": self.links[own], "root": self.node[roots(self.parent)[own]]})


def _sides(left: pd.DataFrame, right: pd.DataFrame) -> tuple[pd.DataFrame, bool] | None:
    """The right side (a block with itself comes without one) and whether it is the left one; None: nothing to compare."""
    same = bool(len(left) and left["i"].iloc[0] == left["j"].iloc[0])
    return (left if same else right, same) if len(left) and (same or len(right)) else None


def _code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for dim, rows in batch.groupby("dim"):
            codes = Codes.of(levelled(matrix(rows["v"])))
            yield rows[["v", "rep", "n", "dim"]].assign(code=[c.tobytes() for c in codes.code], scale=codes.scale,
                                                        length=codes.length, error=codes.error)


def _by_codes(left: pd.DataFrame, right: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """(rep, links, root) per class with certain links in this block pair (``side`` 0), and a row per class
    with undecided pairs (``side`` 1 left, 2 right)."""
    sides = _sides(left, right)
    if sides is None:
        return pd.DataFrame({c: [] for c in ("rep", "links", "root", "dim", "i", "j", "side")}).astype("int64")
    right, same = sides
    a = Codes.read(left)
    b = a if same else Codes.read(right)
    found = _Found(left, right)
    open_a, open_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    for i, j, sure in tile(a, b, threshold, same):
        found.add(i[sure], j[sure])
        open_a[i[~sure]] = True
        open_b[j[~sure]] = True
    parts = [found.rows().assign(side=0)]
    if same:
        open_a |= open_b
        open_b[:] = False
    for rows, undecided, side in ((left, open_a, 1), (right, open_b, 2)):
        rows = rows[undecided]
        parts.append(pd.DataFrame({"rep": rows["rep"], "links": 0, "root": rows["rep"], "side": side}))
    return pd.concat(parts).assign(**{c: int(left[c].iloc[0]) for c in ("dim", "i", "j")})


def _by_components(rows: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """(rep, links, root) of a block pair's undecided pairs that reach the threshold; ``rows`` holds all their vectors."""
    left, right = rows[rows["side"] == 1], rows[rows["side"] == 2]
    sides = _sides(left, right)
    if sides is None:
        return pd.DataFrame({"rep": [], "links": [], "root": []}).astype("int64")
    right, same = sides
    v = levelled(matrix(left["v"]))
    w = v if same else levelled(matrix(right["v"]))
    a = Codes.read(left)
    found = _Found(left, right)
    for i, j, sure in tile(a, a if same else Codes.read(right), threshold, same):
        i, j = i[~sure], j[~sure]
        linked = reach(v, w, i, j, threshold)
        found.add(i[linked], j[linked])
    return found.rows()


def embedding_components(vectors: DataFrame, threshold: float = 0.9, rows: int = 16384,
                         id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of ``vectors``.

    Rows link at cosine >= ``threshold``; a cosine of exactly the threshold
    in double precision links. Vectors that are null, empty, zero
    or hold a null or non-finite component, and rows without a vec_id, link
    with nothing (``n_links`` 0, own component; a null vec_id has a null
    component and is not kept). Equal vectors are compared once and count
    with their number of rows; repeated rows are rows of their own. Vectors
    of different lengths do not link. An empty table gives an empty result;
    other columns are not read, whatever their names.

    The classes of equal vectors are dealt into blocks of about ``rows``; each
    pair of blocks is one task's work, which returns link counts and a
    spanning forest, not pairs. A class's codes go to as many block pairs as
    there are blocks; its components go to those where a pair is undecided.
    """
    each = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    good = each.where(f"vec_id IS NOT NULL AND {usable('v')} AND exists(v, x -> x <> 0)")
    classes = stage(good.groupBy("v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))
                    .select("v", "rep", "n", F.size("v").alias("dim")).mapInPandas(_code, _CODED), "embedding-classes")
    dealt, blocks = deal(classes, "rep", rows)
    left = dealt.withColumn("i", F.col("block")).withColumn("j", F.explode(F.sequence(F.col("block"), F.lit(blocks - 1))))
    right = (dealt.withColumn("j", F.col("block")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("block"))))
             .where("i <> j"))
    key = ["dim", "i", "j"]
    shipped = [*key, "rep", "n", "code", "scale", "length", "error"]
    met = stage(left.select(*shipped).groupBy(*key).cogroup(right.select(*shipped).groupBy(*key))
                .applyInPandas(lambda a, b: _by_codes(a, b, threshold), f"{_LINKS}, dim int, i int, j int, side int"),
                "embedding-met")
    coded = classes.select(F.col("rep").alias("r"), "n", "v", "code", "scale", "length", "error")
    undecided = met.where("side > 0").select(*key, "rep", "side").join(coded, F.col("rep") == F.col("r")).drop("r")
    settled = stage(undecided.groupBy(*key).applyInPandas(lambda rows: _by_components(rows, threshold), _LINKS),
                    "embedding-settled")
    found = met.where("side = 0").select("rep", "links", "root").unionByName(settled)
    part = components(found.selectExpr("rep AS a", "root AS b"))
    linked = found.groupBy("rep").agg(F.sum("links").alias("links")).withColumnRenamed("rep", "r")
    known = (classes.join(linked, classes.rep == linked.r, "left").join(part, classes.rep == part.node, "left")
             .selectExpr("v AS v_", "coalesce(links, 0) + n - 1 AS n_links", "coalesce(component, rep) AS component_id"))
    usable_v = F.expr(f"CASE WHEN vec_id IS NOT NULL AND {usable('v')} AND exists(v, x -> x <> 0) THEN v END")
    return (each.withColumn("v", usable_v).join(known, F.col("v") == F.col("v_"), "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))
