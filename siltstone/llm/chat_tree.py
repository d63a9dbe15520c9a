"""Chat formatting as prefix trees.

Conversations are sorted by the chain of their turns' hashes, which is the depth-first order of the prefix tree of
all conversations. Each task walks its part of that order and packs it: turns shared with the conversation before are
emitted once, and every further turn once, with position ids that continue its path. A turn
attends to itself and to the intervals of its ancestors. A pack is closed when it is full, so a first turn
that very many conversations share is repeated once per pack and never gathers them in one task.

The template marks a turn as ``<|im_start|>role\\ntext<|im_end|>\\n``. Control strings inside roles and texts are
escaped: a backslash is doubled, and ``\\e`` goes behind the first character of a control string.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from siltstone.llm.frames import spread

# The marks of this template and of others that texts may imitate.
START, END = "<|im_start|>", "<|im_end|>"
CONTROLS = (START, END, "<|endoftext|>", "<|startoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
PACKS = (
    "pack_id string, ids array<int>, position_ids array<int>, loss_mask array<boolean>, "
    "turns array<struct<start:int,end:int,parent:int,ancestors:array<struct<start:int,end:int>>>>, "
    "conversations array<struct<conv_id:{id},turn:int>>"
)


def byte_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@dataclass(frozen=True)
class Chat:
    """``window``: tokens a pack is filled to (a longer conversation has a pack of its own)."""

    window: int = 16_384
    conversations: int = 4_096
    trained: str = "assistant"
    tokenizer: str = field(default_factory=byte_bpe_path)


@lru_cache(2)
def _tokenizer(path: str) -> Tokenizer:
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


def escape(text: str, newline: bool = False) -> str:
    text = text.replace("\\", "\\\\")
    for control in CONTROLS:
        text = text.replace(control, f"{control[0]}\\e{control[1:]}")
    return text.replace("\n", "\\n") if newline else text


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: {"\\": "\\", "e": "", "n": "\n"}[m[1]], text)


def formatted(role: str, text: str) -> tuple[str, str, str]:
    """What comes before the text of a turn, the escaped text, and what follows."""
    return f"{START}{escape(role, True)}\n", escape(text), f"{END}\n"


def parsed(turn: str) -> tuple[str, str]:
    if not (turn.startswith(START) and turn.endswith(f"{END}\n")):
        raise ValueError("a turn is not marked as one")
    role, _, text = turn[len(START) : -len(END) - 1].partition("\n")
    return unescape(role), unescape(text)


def conversations(turns: DataFrame) -> DataFrame:
    """One row per ``conv_id``: its turns in order, and the chain of their hashes.

    A conversation is one sequence of training text, hence one row.
    """
    held = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    whole = turns.select("conv_id", "turn", text("role"), text("text")).groupBy("conv_id").agg(
        F.transform(held, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns")
    )
    chain = F.transform("turns", lambda t: F.xxhash64(t["role"], t["text"]))
    return whole.withColumn("path", chain)


class _Pack:
    def __init__(self):
        self.ids, self.position, self.loss = [], [], []
        self.turns, self.depth, self.found = [], [], []

    def add(self, parent: int, pieces: list[tuple[list[int], bool]]) -> int:
        start = len(self.ids)
        at = self.depth[parent] if parent >= 0 else 0
        for ids, trained in pieces:
            self.ids += ids
            self.loss += [trained] * len(ids)
        count = len(self.ids) - start
        self.position += range(at, at + count)
        self.depth.append(at + count)
        above = self.turns[parent]["ancestors"] + [{"start": self.turns[parent]["start"], "end": self.turns[parent]["end"]}] if parent >= 0 else []
        if len(above) > 1 and above[-2]["end"] == above[-1]["start"]:
            above = [*above[:-2], {"start": above[-2]["start"], "end": above[-1]["end"]}]
        self.turns.append({"start": start, "end": start + count, "parent": parent, "ancestors": above})
        return len(self.turns) - 1


def _packed(chat: Chat):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(chat.tokenizer)
        pack, path, number = _Pack(), [], 0
        part, id_type = TaskContext.get().partitionId(), None

        def closed() -> pa.RecordBatch:
            nonlocal pack, path, number
            span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
            turn = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("parent", pa.int32()), ("ancestors", pa.list_(span))])
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([f"{part}-{number}"]), pa.array([pack.ids], pa.list_(pa.int32())),
                    pa.array([pack.position], pa.list_(pa.int32())), pa.array([pack.loss], pa.list_(pa.bool_())),
                    pa.array([pack.turns], pa.list_(turn)),
                    pa.array([pack.found], pa.list_(pa.struct([("conv_id", id_type), ("turn", pa.int32())]))),
                ],
                names=["pack_id", "ids", "position_ids", "loss_mask", "turns", "conversations"],
            )
            pack, path, number = _Pack(), [], number + 1
            return out

        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            for conv, turns in zip(batch.column("conv_id").to_pylist(), batch.column("turns").to_pylist(), strict=True):
                keys = [(t["role"], t["text"]) for t in turns]
                shared = 0
                while shared < min(len(path), len(keys)) and path[shared][0] == keys[shared]:
                    shared += 1
                texts = [s for role, text in keys[shared:] for s in formatted(role, text)]
                coded = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
                if pack.found and (
                    len(pack.ids) + sum(map(len, coded)) > chat.window or len(pack.found) >= chat.conversations
                ):
                    yield closed()
                    shared = 0
                    texts = [s for role, text in keys for s in formatted(role, text)]
                    coded = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
                del path[shared:]
                for k, key in enumerate(keys[shared:]):
                    head, text, tail = coded[3 * k : 3 * k + 3]
                    node = pack.add(path[-1][1] if path else -1, [(head, False), (text, key[0] == chat.trained), (tail, False)])
                    path.append((key, node))
                pack.found.append({"conv_id": conv, "turn": path[-1][1]})
        if pack.found:
            yield closed()

    return run


def format_chats(turns: DataFrame, chat: Chat | None = None) -> DataFrame:
    """Packs of formatted conversations: pack_id, ids, position_ids, loss_mask, turns, conversations.

    ``turns`` needs ``conv_id``, ``turn``, ``role`` and ``text``; further columns are ignored. ``turns`` of a pack hold where a
    turn's tokens lie, its parent turn (-1: none) and the intervals of its ancestors that it attends to besides
    itself; ``conversations`` their last turns. The loss mask is set on the texts of the trained role. Rows are ordered by
    turn, ties by role and text, null turns first; null roles and texts count as empty; repeated rows are turns of their own;
    rows without ``conv_id`` form one conversation. An empty table gives no rows.
    """
    chat = chat or Chat()
    kind = turns.schema["conv_id"].dataType.simpleString()
    # The id in the range key splits a conversation that very many others equal.
    laid = (
        conversations(turns).repartitionByRange(spread(turns.sparkSession), "path", "conv_id")
        .sortWithinPartitions("path", "conv_id").select("conv_id", "turns")
    )
    return laid.mapInArrow(_packed(chat), PACKS.format(id=kind))


def _read(chat: Chat):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(chat.tokenizer)
        decode = lambda ids: tokenizer.decode(ids, skip_special_tokens=False)
        for batch in batches:
            out, id_type = [], batch.schema.field("conversations").type.value_type.field("conv_id").type
            for row in batch.to_pylist():
                ids, loss = np.array(row["ids"], np.int64), np.array(row["loss_mask"], bool)
                read = []
                for t in row["turns"]:
                    own, mask = ids[t["start"] : t["end"]], loss[t["start"] : t["end"]]
                    turn = decode(own.tolist())
                    read.append((parsed(turn), unescape(decode(own[mask].tolist())), len(turn)))
                for c in row["conversations"]:
                    at, path = c["turn"], []
                    while at >= 0:
                        path.append(read[at])
                        at = row["turns"][at]["parent"]
                    path.reverse()
                    turns = hashlib.sha256("".join(f"{r}\n{t}\n" for (r, t), _, _ in path).encode())
                    trained = "".join(x for _, x, _ in path)
                    out.append((c["conv_id"], len(path), turns.hexdigest(), len(trained), hashlib.sha256(trained.encode()).hexdigest(), sum(n for *_, n in path)))
            columns = list(zip(*out, strict=True)) or [()] * 6
            kinds = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    return run


def read_chats(packs: DataFrame, chat: Chat | None = None) -> DataFrame:
    """Every conversation of the packs, decoded from its tokens along its path of turns."""
    kind = packs.schema["conversations"].dataType.elementType["conv_id"].dataType.simpleString()
    return packs.mapInArrow(
        _read(chat or Chat()),
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
