"""Integer-lattice geometry for k-means over (x, y) points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Beyond this many centres the unrolled distances pass the 8,000 bytes of
# bytecode up to which the JVM compiles a method.
UNROLLED = 64


def sq_distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Squared euclidean distance, exact in 64-bit integers."""
    dx = x1.cast("bigint") - x2.cast("bigint")
    dy = y1.cast("bigint") - y2.cast("bigint")
    return dx * dx + dy * dy


def _sql_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def nearest_center(x: Column | str, y: Column | str,
                   centers: Sequence[tuple[int, int, int]]) -> Column:
    """Id of the centre closest to (x, y); equal distances go to the lower id.

    `centers` is a list of (center_id, cx, cy). Up to `UNROLLED` centres the
    result is the place of the least of the distances d_0 .. d_k, plain
    primitive arithmetic that whole-stage codegen keeps within the size the
    JVM compiles. More centres are a literal array walked by a higher-order
    function, whose code does not grow with k. Centres are tried in id order,
    and the first of equal distances is found.
    """
    if not centers:
        raise ValueError("at least one centre is needed")
    centers = sorted((int(cid), int(cx), int(cy)) for cid, cx, cy in centers)
    ids = F.array(*[F.lit(cid) for cid, _, _ in centers])
    if len(centers) == 1:
        return F.lit(centers[0][0])
    if len(centers) > UNROLLED:
        places = F.array(*[F.struct(F.lit(cx).cast("bigint").alias("x"), F.lit(cy).cast("bigint").alias("y"))
                           for _, cx, cy in centers])
        xc, yc = (F.col(c) if isinstance(c, str) else c for c in (x, y))
        found = F.array_min(F.transform(places, lambda c, i: F.struct(
            sq_distance(xc, yc, c["x"], c["y"]).alias("d"), i.alias("i"))))["i"]
        return F.element_at(ids, found + 1)
    if isinstance(x, str) and isinstance(y, str):
        xs, ys = f"CAST({_sql_name(x)} AS BIGINT)", f"CAST({_sql_name(y)} AS BIGINT)"
        ds = ", ".join(f"({xs} - {cx}) * ({xs} - {cx}) + ({ys} - {cy}) * ({ys} - {cy})" for _, cx, cy in centers)
        at = f"array_position(array({ds}), least({ds}))"
        if [cid for cid, _, _ in centers] == list(range(len(centers))):
            return F.expr(f"CAST({at} - 1 AS INT)")
        return F.element_at(ids, F.expr(f"CAST({at} AS INT)"))
    xc, yc = (F.col(c) if isinstance(c, str) else c for c in (x, y))
    cols = [sq_distance(xc, yc, F.lit(cx), F.lit(cy)) for _, cx, cy in centers]
    return F.element_at(ids, F.array_position(F.array(*cols), F.least(*cols)).cast("int"))


def bands(x: int, centers: Sequence[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """(least y, center_id) pieces of the line at `x`, by rising y: from each
    y on, that centre is the closest one until the next piece begins; equal
    distances go to the lower id.

    Along the line two centres change places once, at an integer y found in
    exact arithmetic, so the pieces are the lower envelope of k parabolas of
    one width: a stack over the centres by rising cy. The first piece has no
    least y and gets -2^63.
    """
    def takes_over(a: tuple[int, int, int], b: tuple[int, int, int]) -> int:
        """The least y from which b is closer than a (b has the greater cy)."""
        twice = 2 * (b[0] - a[0])
        gap = b[0] * b[0] - a[0] * a[0] + b[1] - a[1]
        return -(-gap // twice) if b[2] < a[2] else gap // twice + 1

    lines: list[tuple[int, int, int]] = []  # (cy, squared distance in x, id), one for each cy
    for line in sorted((cy, (x - cx) ** 2, cid) for cid, cx, cy in centers):
        if not lines or lines[-1][0] != line[0]:
            lines.append(line)
    kept: list[tuple[int, int, int]] = []
    begins: list[int] = []
    for line in lines:
        while kept and (at := takes_over(kept[-1], line)) <= begins[-1]:
            kept.pop()
            begins.pop()
        begins.append(at if kept else -(1 << 63))
        kept.append(line)
    return [(at, cid) for at, (_, _, cid) in zip(begins, kept) if at < 1 << 63]


def int_div(a: Column, b: Column) -> Column:
    """Integer division truncated toward zero (SQL `a div b`), exact for 64-bit values."""
    return F.call_function("div", a, b)
