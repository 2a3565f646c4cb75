"""Python models as files in a shared folder, mapped into the memory of every Python worker that scores."""

from __future__ import annotations

import hashlib
import pickle
from dataclasses import dataclass, field
from functools import lru_cache
from uuid import uuid4

import pyarrow as pa
from pyarrow.fs import FileSystem, FileType, LocalFileSystem
from pyspark import cloudpickle
from pyspark.sql import SparkSession

from strataprop.functions.runtime import shared_folder

# The file: this mark, the digest, the number of parts, the place and length of each, then the parts.
MARK, ALIGN = b"strataprop-model", 64
HEAD = len(MARK) + 32 + 8


@dataclass(frozen=True)
class ModelFile:
    """A model that was written: where, how many bytes, and the digest of its content. Equal if the content is."""

    path: str = field(compare=False)
    size: int
    digest: str


def _parts(model) -> list:
    """The pickled model and its arrays, which stay out of the pickle so that a reader need not copy them."""
    arrays: list = []
    pickled = cloudpickle.dumps(model, protocol=5, buffer_callback=arrays.append)
    return [memoryview(pickled), *[a.raw() for a in arrays]]


def _places(parts: list) -> list[tuple[int, int]]:
    at, places = HEAD + 16 * len(parts), []
    for part in parts:
        at += -at % ALIGN
        places.append((at, part.nbytes))
        at += part.nbytes
    return places


def save_model(
    spark: SparkSession, model, path: str | None = None, max_bytes: int | None = None
) -> ModelFile:
    """Write a model to a path all executors can read, by default in the shared folder under its digest.

    A file with the same bytes is kept as it is (an object whose class has no module may be pickled differently
    each time: save it once to score often); another file at ``path`` is replaced as a whole. A model of
    more than ``max_bytes`` is refused before anything is written.
    """
    parts = _parts(model)
    places = _places(parts)
    size = sum(places[-1])
    if max_bytes is not None and size > max_bytes:
        raise ValueError(f"the model has {size} bytes, more than the {max_bytes} allowed")
    digest = hashlib.sha256()
    for part in parts:
        digest.update(part.nbytes.to_bytes(8, "little"))
        digest.update(part)
    path = path or f"{shared_folder(spark).rstrip('/')}/model-{digest.hexdigest()[:40]}"
    saved = ModelFile(path, size, digest.hexdigest())
    files, name = FileSystem.from_uri(path)
    if files.get_file_info(name).type != FileType.NotFound and open_model(path) == saved:
        return saved
    files.create_dir(name.rpartition("/")[0])
    # readers see the whole file or none
    draft = f"{name}.{uuid4().hex}"
    with files.open_output_stream(draft) as out:
        out.write(MARK + digest.digest() + len(parts).to_bytes(8, "little"))
        for start, length in places:
            out.write(start.to_bytes(8, "little") + length.to_bytes(8, "little"))
        for part, (start, _) in zip(parts, places):
            out.write(bytes(start - out.tell()))
            out.write(part)
    files.move(draft, name)
    return saved


def _places_in(table: bytes) -> list[tuple[int, int]]:
    numbers = [int.from_bytes(table[i : i + 8], "little") for i in range(0, len(table), 8)]
    return list(zip(numbers[::2], numbers[1::2]))


def open_model(path: str) -> ModelFile:
    """A model that was saved before; reads its head only."""
    files, name = FileSystem.from_uri(path)
    with files.open_input_file(name) as source:
        head = source.read(HEAD)
        if head[: len(MARK)] != MARK:
            raise ValueError(f"{path} is not a saved model")
        return ModelFile(path, source.size(), head[len(MARK) : len(MARK) + 32].hex())


@lru_cache(maxsize=2)
def load_model(saved: ModelFile):
    """The model, once per process: two tasks of one worker, or two jobs, share it, and the last two models stay.

    On a local or mounted folder its arrays are the mapped file itself, read-only and shared by all workers of a
    machine; from another store each worker reads the file once. Unpickling runs code, so load trusted files only.
    """
    files, name = FileSystem.from_uri(saved.path)
    local = isinstance(files, LocalFileSystem)
    source = pa.memory_map(name, "r") if local else files.open_input_file(name)
    whole = source.read_buffer()
    head = whole.slice(0, HEAD).to_pybytes()
    if head[len(MARK) : len(MARK) + 32].hex() != saved.digest:
        raise ValueError(f"{saved.path} holds another model than the one that was opened")
    count = int.from_bytes(head[-8:], "little")
    pickled, *arrays = [
        whole.slice(*place) for place in _places_in(whole.slice(HEAD, 16 * count).to_pybytes())]
    return pickle.loads(pickled, buffers=arrays)


def remove_model(saved: ModelFile) -> None:
    """Delete the file. Scored tables that were not written yet can no longer be computed."""
    files, name = FileSystem.from_uri(saved.path)
    files.delete_file(name)
