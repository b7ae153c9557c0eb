"""Packing examples into training sequences: vector bin packing by dot products.

Every example has three demands -- tokens, one segment, and loss-bearing
tokens -- and every sequence three limits. The open sequence takes, among the
waiting examples that fit all limits, the one whose demand vector has the
largest dot product with the sequence's remaining capacities (both as shares of
the limits), so examples that use what is plentiful go first. When nothing fits
and cutting is allowed, the longest waiting example is cut to fill the rest. Cut examples longer than a sequence first give whole sequences.

Each task packs the documents it reads, with a bounded number waiting, so
nothing is shuffled and memory does not grow with the partition. A sequence that
the segment or loss limit closes before it is full, and what is left in a task's
last one, is dealt into sequences of 512, 256, ... tokens (powers of two need no
padding).

A column of masks may name the loss-bearing ids of each document, its end id the
last; ids beyond the mask bear none, and without a mask (null) all do.

Edge cases: a null or empty text is its end id alone, one piece of length 1.
Null ids stay null. Repeated rows are packed each for itself. ``sequence_id``
is (partition number, count) in one long, the same in a repeated task.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from churnspark.llm.common import col, small_batches

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, n_loss long, sequence_id long, "
          "offset long")


@dataclass(frozen=True)
class Limits:
    tokens: int = 1024
    segments: int = 64
    loss: int = 1024
    waiting: int = 256


@dataclass
class Item:
    """A run of ids of one example; ``loss`` marks loss-bearing ids (None: all)."""

    doc: object
    start: int
    ids: np.ndarray
    total: int
    loss: np.ndarray | None = None

    def demand(self) -> tuple[int, int, int]:
        return len(self.ids), 1, len(self.ids) if self.loss is None else int(self.loss.sum())

    def cut(self, n: int) -> tuple[Item, Item]:
        mask = (None, None) if self.loss is None else (self.loss[:n], self.loss[n:])
        return (Item(self.doc, self.start, self.ids[:n], self.total, mask[0]),
                Item(self.doc, self.start + n, self.ids[n:], self.total, mask[1]))


@dataclass
class Packer:
    """Streams items into sequences; ``rows`` collects the finished pieces."""

    limits: Limits = Limits()
    cut: bool = True
    first_id: int = 0
    rows: list[tuple] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.cap = np.array([self.limits.tokens, self.limits.segments, self.limits.loss], float)
        self.pool: list[Item] = []
        self.need = np.zeros((self.limits.waiting + 1, 3))
        self.open: list[Item] = []
        self.left = self.cap.copy()
        self.made = 0

    def _emit(self, items: list[Item]) -> None:
        offset = 0
        for x in items:
            crc = zlib.crc32(x.ids.astype("<u4").tobytes())
            self.rows.append((x.doc, x.start, len(x.ids), crc, x.total, x.demand()[2], self.first_id + self.made, offset))
            offset += len(x.ids)
        self.made += bool(items)

    def _close(self) -> None:
        own, self.open, self.left = self.open, [], self.cap.copy()
        if self.cut:
            self._deal(own)
        else:
            self._emit(own)

    def _deal(self, own: list[Item]) -> None:
        """The largest powers of two that fit, as sequences without padding; a full sequence stays one."""
        room = sum(len(x.ids) for x in own)
        if room == self.limits.tokens:
            self._emit(own)
            return
        size = 1 << (self.limits.tokens.bit_length() - 1)
        while room:
            while size > room:
                size >>= 1
            want, part = size, []
            while want:
                x = own.pop(0)
                if len(x.ids) > want:
                    x, rest = x.cut(want)
                    own.insert(0, rest)
                part.append(x)
                want -= len(x.ids)
            self._emit(part)
            room -= size

    def _place(self, item: Item) -> None:
        self.open.append(item)
        self.left -= item.demand()
        if self.left[0] == 0:
            self._close()

    def _take(self, i: int) -> Item:
        item, n = self.pool[i], len(self.pool) - 1
        self.pool[i], self.need[i] = self.pool[n], self.need[n]
        self.pool.pop()
        return item

    def _wait(self, item: Item) -> None:
        self.need[len(self.pool)] = item.demand()
        self.pool.append(item)

    def _step(self) -> None:
        """Place one waiting item, or part of one, or close the open sequence."""
        need = self.need[: len(self.pool)]
        fits = (need <= self.left).all(axis=1)
        if fits.any():
            worth = np.where(fits, (need / self.cap) @ (self.left / self.cap), -1.0)
            self._place(self._take(int(worth.argmax())))
            return
        longest = int(need[:, 0].argmax())
        fill = min(int(self.left[0]), self._within_loss(self.pool[longest])) if self.cut and self.left[1] >= 1 else 0
        if fill:
            head, tail = self._take(longest).cut(fill)
            self._wait(tail)
            self._place(head)
        elif self.open:
            self._close()
        else:
            raise ValueError("an example exceeds the limits of a sequence and may not be cut")

    def _within_loss(self, item: Item) -> int:
        """Ids from the start of ``item`` that the open sequence's loss limit admits."""
        if item.loss is None:
            return min(int(self.left[2]), len(item.ids) - 1)
        return min(int(np.searchsorted(np.cumsum(item.loss), self.left[2], side="right")), len(item.ids) - 1)

    def add(self, item: Item) -> None:
        if self.cut:
            while len(item.ids) >= self.limits.tokens and item.loss is None and self.limits.loss >= self.limits.tokens:
                head, item = item.cut(self.limits.tokens)
                self._emit([head])
            if not len(item.ids):
                return
        self._wait(item)
        while len(self.pool) >= self.limits.waiting:
            self._step()

    def finish(self) -> None:
        while self.pool:
            self._step()
        self._close()


def byte_names() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Ids:
    """Ids of a byte-level vocabulary file (JSON), as its own library gives them without added special tokens.

    The vocabulary numbers its merges in order, so tiktoken, given the same
    vocabulary as ranks, yields the same ids several times as fast."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        names = byte_names()
        special = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
        ranks = {bytes(names[c] for c in k): v for k, v in spec["model"]["vocab"].items() if k not in special}
        self.engine = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None

    def __call__(self, text: str) -> np.ndarray:
        if self.special and self.special.search(text):
            return np.array(self.engine.encode(text, allowed_special="all"), np.uint32)
        return np.array(self.engine.encode_ordinary(text), np.uint32)


@functools.lru_cache(maxsize=2)
def ids_of(path: str) -> Ids:
    """One ``Ids`` a worker process. Tasks reach it by this name: a cache held by the task's own function would come
    with the function as a copy, and every task would load the vocabulary again."""
    return Ids(path)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def loss_mask(mask: list[bool | None], n: int) -> np.ndarray:
    """``mask`` for ``n`` ids; missing marks bear no loss."""
    out = np.zeros(n, bool)
    out[: len(mask)] = [bool(x) for x in mask[:n]]
    return out


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0,
         limits: Limits = Limits(), cut: bool = True, loss_col: str | None = None) -> DataFrame:
    """Pieces (``PIECES``) of all documents' ids, each document closed by ``end_id``. ``path``: vocabulary file;
    ``loss_col``: an ``array<boolean>`` of loss-bearing ids (see the module's head)."""
    small_batches(docs.sparkSession)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = ids_of(path)
        packer = Packer(limits, cut, TaskContext.get().partitionId() << 36)
        end = np.array([end_id], np.uint32)

        def out() -> pa.RecordBatch:
            columns = list(zip(*packer.rows)) or [()] * 8
            packer.rows = []
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                              names=[x.split()[0] for x in PIECES.split(", ")])

        for batch in batches:
            masks = batch.column(2).to_pylist() if loss_col else [None] * batch.num_rows
            for doc, text, mask in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), masks):
                own = np.concatenate([ids(text or ""), end])
                packer.add(Item(doc, 0, own, len(own), None if mask is None else loss_mask(mask, len(own))))
            yield out()
        packer.finish()
        yield out()

    columns = [col(id_col).cast("long").alias("doc_id"), col(text_col).alias("text")] + ([col(loss_col).alias("loss")] if loss_col else [])
    return docs.select(columns).mapInArrow(packed, PIECES)
