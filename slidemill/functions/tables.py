"""Table functions for SQL: ``register(spark)`` makes ``tile_grid`` and ``suppress`` known to a session."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

CELL = 128


@udtf(returnType="r0 int, c0 int")
class TileGrid:
    """``tile_grid(width, height, patch, stride)``: the first row and column of every tile that lies in the image."""

    def eval(self, width: int, height: int, patch: int = 1024, stride: int = 256) -> Iterator[tuple[int, int]]:
        if width is not None and height is not None:
            for r in range(0, height - patch + 1, stride):
                for c in range(0, width - patch + 1, stride):
                    yield r, c


@udtf
class Suppress:
    """``suppress(TABLE(boxes) PARTITION BY image_id ORDER BY (confidence DESC, ord), num, den)``: the rows that ``boxes.nms`` keeps.

    A row comes out as it came in. Within an image a box looks only at kept boxes of the grid cells it touches. (For a crowded
    image that should not be one task, ``boxes.nms`` is the way.)
    """

    def __init__(self):
        self.cells = defaultdict(list)

    @staticmethod
    def analyze(boxes: AnalyzeArgument, num: AnalyzeArgument | None = None, den: AnalyzeArgument | None = None) -> AnalyzeResult:
        if not boxes.isTable or not isinstance(boxes.dataType, StructType):
            raise ValueError("suppress takes a table of boxes")
        lacking = {"x", "y", "w", "h"} - set(boxes.dataType.names)
        if lacking:
            raise ValueError(f"boxes lack {', '.join(sorted(lacking))}")
        return AnalyzeResult(schema=boxes.dataType)

    def eval(self, boxes: Row, num: int = 3, den: int = 10) -> Iterator[Row]:
        x, y, w, h = (boxes[c] for c in "xywh")
        touched = [(i, j) for i in range(x // CELL, max(x, x + w - 1) // CELL + 1) for j in range(y // CELL, max(y, y + h - 1) // CELL + 1)]
        for cell in touched:
            for a, b, c, d in self.cells[cell]:
                inter = max(0, min(x + w, a + c) - max(x, a)) * max(0, min(y + h, b + d) - max(y, b))
                if den * inter > num * (w * h + c * d - inter):
                    return
        for cell in touched:
            self.cells[cell].append((x, y, w, h))
        yield boxes


def register(spark: SparkSession) -> None:
    spark.udtf.register("tile_grid", TileGrid)
    spark.udtf.register("suppress", Suppress)
