"""Model steps as injected scorers: what a model returns enters as a table; the engine batches, checks and stores."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..config import CLASSES

#: Images for one call of a model.
BATCH = 50


class Detector(Protocol):
    """ML-01: boxes (class id, confidence, x1, y1, x2, y2) of each image."""

    def __call__(self, images: list[bytes]) -> Iterable[list[tuple[int, float, float, float, float, float]]]: ...


class Embedder(Protocol):
    """ML-03: a vector of each image."""

    def __call__(self, images: list[bytes]) -> Iterable[list[float]]: ...


def class_name(class_id: int) -> str:
    return CLASSES[class_id] if 0 <= class_id < len(CLASSES) else f"Unknown-{class_id}"


def detect(images: DataFrame, load: Callable[[], Detector], key: str, least: float = 0.25, batch: int = BATCH) -> DataFrame:
    """ML-01/02, VF-01: detections of images (key, content).  load() runs once a task, so a model is loaded once for many images."""
    kind = images.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load()
        for part in batches:
            for a in range(0, part.num_rows, batch):
                cut = part.slice(a, batch)
                names = cut.column(0).to_pylist()
                found = [(n, c, class_name(c), p, x1, y1, x2, y2) for n, boxes in zip(names, model(cut.column(1).to_pylist()), strict=True) for c, p, x1, y1, x2, y2 in boxes if p >= least]
                columns = list(zip(*found, strict=True)) if found else [[]] * 8
                types = (cut.column(0).type, pa.int32(), pa.string(), *[pa.float64()] * 5)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[key, "class_id", "class_name", "confidence", "x1", "y1", "x2", "y2"])

    return images.select(key, "content").mapInArrow(run, f"{key} {kind}, class_id int, class_name string, confidence double, x1 double, y1 double, x2 double, y2 double")


def embed(images: DataFrame, load: Callable[[], Embedder], key: str, batch: int = BATCH) -> DataFrame:
    """ML-03: embeddings of images (key, content)."""
    kind = images.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load()
        for part in batches:
            for a in range(0, part.num_rows, batch):
                cut = part.slice(a, batch)
                vectors = [[float(v) for v in e] for e in model(cut.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([cut.column(0), pa.array(vectors, pa.list_(pa.float32()))], names=[key, "embedding"])

    return images.select(key, "content").mapInArrow(run, f"{key} {kind}, embedding array<float>")


def readable(images: DataFrame, least: int = 1000) -> DataFrame:
    """VF-01: JPEG or PNG by its first bytes, and long enough."""
    head = F.hex(F.substring("content", 1, 4))
    return images.where((F.octet_length("content") >= least) & (head.startswith("FFD8FF") | (head == "89504E47")))
