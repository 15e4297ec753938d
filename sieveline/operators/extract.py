"""Contextual extraction: a pluggable backend in one Arrow-batched stage.

A backend names the places it finds, each with a label and perhaps a confidence. The stage only calls it, pass by pass; thresholds by
label, the joining of passes and everything later are Catalyst expressions over what it found. Only text columns go to Python. A backend is built
once in each Python worker and kept there from task to task, since a model's weights may take longer to read than a task's texts.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections import OrderedDict
from collections.abc import Callable, Sequence
from pathlib import Path
from typing import NamedTuple, Protocol

import pyarrow as pa
from pyspark import SparkFiles, TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline import labels as L
from sieveline.functions import validate
from sieveline.sources.files import check_model_folder


class Found(NamedTuple):
    """One finding. Without a start it can't be held against a threshold by label; without a confidence it is certain."""

    label: str
    value: str | None
    start: int | None = None
    confidence: float | None = None


class Backend(Protocol):
    """For each text what it holds of some labels at a threshold.

    It may offer batch_size (texts it takes at a time), memory_errors (exceptions after which fewer texts may do; MemoryError and
    RuntimeError unless it says otherwise) and to_cpu().
    """

    def extract(self, texts: Sequence[str], labels: Sequence[str], threshold: float) -> list[list[Found]]: ...


class NullExtractor:
    """Finds nothing: what rules and patterns tell is all there is."""

    def extract(self, texts, labels, threshold):
        return [[] for _ in texts]


class GazetteerExtractor:
    """Finds listed phrases as whole words, case aside: a deterministic stand-in for a model, with no accuracy to speak of."""

    def __init__(self, phrases: dict[str, Sequence[str]]):
        self.patterns = {label: re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, sorted(words, key=len, reverse=True))) + r")(?!\w)", re.IGNORECASE) for label, words in phrases.items() if words}

    def extract(self, texts, labels, threshold):
        asked = [(label, p) for label, p in self.patterns.items() if label in labels]
        return [[Found(label, m[0], m.start(), 1.0) for label, p in asked for m in p.finditer(t)] for t in texts]


class ModelAdapter:
    """Wraps a model with predict_entities(text, labels, threshold): dicts of label, text and perhaps start and score.

    A batch form of it is used where there is one; texts that it fails on are asked for one by one.
    """

    def __init__(self, model, batch_size: int | None = None, memory_errors: tuple[type[Exception], ...] = (MemoryError, RuntimeError)):
        self.model, self.batch_size, self.memory_errors = model, batch_size, memory_errors

    def to_cpu(self) -> None:
        if hasattr(self.model, "to"):
            self.model = self.model.to("cpu") or self.model

    def extract(self, texts, labels, threshold):
        return [[Found(e["label"], e["text"], e.get("start"), e.get("score")) for e in some] for some in self._entities(list(texts), list(labels), threshold)]

    def _entities(self, texts: list[str], labels: list[str], threshold: float):
        if len(texts) > 1 and hasattr(self.model, "batch_predict_entities"):
            try:
                return self.model.batch_predict_entities(texts, labels, threshold=threshold)
            except self.memory_errors:
                raise
            except Exception:  # noqa: BLE001 - whatever a model's batch form can't do, its plain form may
                pass
        return [self.model.predict_entities(t, labels, threshold=threshold) for t in texts]


class Retry:
    """What to do about a backend that runs out of memory: ask for half as much, at last off the GPU, and then give up."""

    def __init__(self, backend: Backend, size: int):
        self.backend, self.size = backend, max(1, size)
        self.caught = tuple(getattr(backend, "memory_errors", (MemoryError, RuntimeError)))
        self.ways_left = [backend.to_cpu] if hasattr(backend, "to_cpu") else []

    def after(self, error: Exception) -> None:
        if self.size > 1:
            self.size //= 2
        elif self.ways_left:
            self.ways_left.pop()()
        else:
            raise error


def in_batches(backend: Backend, texts: Sequence[str], labels: Sequence[str], threshold: float, size: int) -> list[list[Found]]:
    """What the backend finds in all texts, batch by batch; batches shrink when memory runs out."""
    retry, at = Retry(backend, size), 0
    out: list[list[Found]] = []
    while at < len(texts):
        part = texts[at : at + retry.size]
        try:
            out += backend.extract(part, labels, threshold)
        except retry.caught as error:
            retry.after(error)
        else:
            at += len(part)
    return out


class Pass(NamedTuple):
    """What a pass asks a backend for, and the threshold that holds for labels without one of their own."""

    labels: tuple[str, ...]
    ask_at: float
    default: float


def planned(passes, threshold: float, thresholds: dict[str, float] | None) -> list[Pass]:
    """The passes with their thresholds settled: each asks low enough for every label's own threshold to decide afterwards."""
    own = thresholds or {}
    settled = [(tuple(labels), threshold if at is None else at) for labels, at in passes]
    return [Pass(labels, min(own.get(x, at) for x in (*labels, None)), at) for labels, at in settled]


def entities_of(found: Sequence[Column], plan: Sequence[Pass], thresholds: dict[str, float] | None) -> Column:
    """The map of label to values of all passes over a text."""
    out = None
    for one, step in zip(found, plan):
        values = validate.by_label(validate.confident(one, step.default, thresholds) if thresholds else one)
        out = values if out is None else validate.merge_passes(out, values)
    return out if out is not None else F.expr("cast(map() as map<string, array<string>>)")


#: Backends that a Python worker keeps; the one that was unused longest goes first.
KEPT_BACKENDS = 2
_kept: OrderedDict[str, Backend] = OrderedDict()


def fingerprint(make: Callable[[], Backend]) -> str:
    """What tells makers apart: the code and the values that they are made of."""
    return hashlib.sha256(cloudpickle.dumps(make)).hexdigest()


def backend_for(mark: str, make: Callable[[], Backend]) -> Backend:
    """This worker's backend with that fingerprint; built if it has none."""
    if mark not in _kept:
        while len(_kept) >= KEPT_BACKENDS:
            _kept.popitem(last=False)
        _kept[mark] = make()
    _kept.move_to_end(mark)
    return _kept[mark]


def device() -> str:
    """The first GPU that Spark gave to this task, or the CPU."""
    task = TaskContext.get()
    gpu = task.resources().get("gpu") if task else None
    return f"cuda:{gpu.addresses[0]}" if gpu and gpu.addresses else "cpu"


#: Settings that keep model libraries off the network.
OFFLINE = {"HF_HUB_OFFLINE": "1", "TRANSFORMERS_OFFLINE": "1", "TOKENIZERS_PARALLELISM": "false"}


def local_model(spark: SparkSession, folder: str, load: Callable[[str, str], Backend], environment: dict[str, str] | None = None) -> Callable[[], Backend]:
    """A maker of backends from a folder of weights: the folder is checked here and sent to every executor once, and load(path, device) reads it there.

    A folder without a config, or with weights that are only a pointer to weights, is an error on the driver.
    """
    path = check_model_folder(folder)
    stamp = sorted((str(f.relative_to(path)), f.stat().st_size, f.stat().st_mtime_ns) for f in path.rglob("*") if f.is_file())
    spark.sparkContext.addFile(str(path), recursive=True)
    name, settings = Path(path).name, OFFLINE if environment is None else environment

    def make(stamp=stamp) -> Backend:
        os.environ.update(settings)
        return load(SparkFiles.get(name), device())

    return make


_FOUND = pa.struct([("label", pa.string()), ("value", pa.string()), ("start", pa.int32()), ("confidence", pa.float64())])


def _lists(found: Sequence[Sequence[Found]]) -> pa.ListArray:
    """The findings of each text as an array of lists of structs."""
    ends = [0]
    for row in found:
        ends.append(ends[-1] + len(row))
    columns = list(zip(*[x for row in found for x in row])) or [()] * len(_FOUND)
    made = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FOUND)], fields=list(_FOUND))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), made)


def with_entities(df: DataFrame, columns: dict[str, str], make: Callable[[], Backend], passes=L.BASE_PASSES, threshold: float = L.DEFAULT_THRESHOLD, batch_size: int | None = None, thresholds: dict[str, float] | None = None, mark: str | None = None) -> DataFrame:
    """df and, for each text column that `columns` names, a map column of entities. The text columns, and no others, cross to Python once for all passes.

    `make` builds the backend, in each Python worker once; a backend's weights are read there, not on the driver. `mark` tells backends
    apart where their makers' code and values don't.
    """
    plan = planned(passes, threshold, thresholds)
    names = [f"found_{k}_{j}" for k in range(len(columns)) for j in range(len(plan))]
    mark = mark or fingerprint(make)

    def run(*texts: pa.Array) -> pa.Array:
        backend = backend_for(mark, make)
        size = batch_size or getattr(backend, "batch_size", None) or 16
        made = []
        for column in texts:
            values = column.fill_null("").to_pylist()
            made += [_lists(in_batches(backend, values, step.labels, step.ask_at, size)) for step in plan]
        return pa.StructArray.from_arrays(made, names)

    if not names:
        return df.withColumns({name: entities_of([], plan, thresholds) for name in columns.values()})
    # Not deterministic, to Catalyst: else a filter on the result would have the backend run twice.
    ask = F.arrow_udf(run, "struct<" + ", ".join(f"{n}: {validate.FOUND}" for n in names) + ">").asNondeterministic()
    (x,) = fresh(df.columns + list(columns.values()), ["found"])
    out = df.withColumn(x, ask(*[F.col(f"`{c}`").cast("string") for c in columns]))
    each = [names[k * len(plan) : (k + 1) * len(plan)] for k in range(len(columns))]
    return out.select(*[F.col(f"`{c}`") for c in df.columns], *[entities_of([F.col(x)[n] for n in own], plan, thresholds).alias(name) for own, name in zip(each, columns.values())])


def fresh(taken: Sequence[str], wanted: Sequence[str]) -> list[str]:
    """Names for columns of our own that no column of the table has, whatever its case."""
    have, mark = {c.lower() for c in taken}, "__"
    while any((mark + w).lower() in have for w in wanted):
        mark += "_"
    return [mark + w for w in wanted]
