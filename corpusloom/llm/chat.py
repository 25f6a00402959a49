"""Chat formatting on tokens: segments encoded on their own, reserved ids spliced in, masks by prefix sums.

A turn is written as ``TURN role-ids SEP content-ids END``, where the three markers are reserved ids above the
vocabulary that no text can produce, and role and content are each encoded on their own. As text the markers read
``<|turn|>``, ``<|sep|>`` and ``<|end|>``. Control strings that occur in a role or a content are escaped first: a
backslash is doubled, and a backslash is put behind the first character of every control string. Both steps can
be undone, and no escaped text holds a control string.

The loss mask covers the content of assistant turns: a token is inside a content where more SEP than END ids stand
before it, which prefix sums over the row tell.

A conversation is the rows of one conv_id by turn (nulls first), then role and text; repeated rows are turns of
their own. Null roles and texts are empty. Every turn is encoded where it is read; only then turns are brought
together, and a task walks through them one by one, whatever the length of a conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.encoding import encoder

# Strings that chat templates give a meaning to.
CONTROL = (
    "<|turn|>",
    "<|sep|>",
    "<|end|>",
    "<s>",
    "</s>",
    "[INST]",
    "[/INST]",
    "<<SYS>>",
    "<</SYS>>",
    "<|im_start|>",
    "<|im_end|>",
    "<|endoftext|>",
    "<|system|>",
    "<|user|>",
    "<|assistant|>",
)
MARKERS = CONTROL[:3]
LOSS_ROLE = "assistant"

_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_ESCAPED = re.compile(r"\\(\\?)")


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    """Undo ``escape``: of two backslashes one stays, a single one goes."""
    return _ESCAPED.sub(lambda m: m[1], text)


class Template:
    """Markers above a vocabulary, and both directions between turns and ids."""

    def __init__(self, path: str):
        self.encoder = encoder(path, True)
        self.size = self.encoder.tokenizer.get_vocab_size(with_added_tokens=True)
        self.turn, self.sep, self.end = self.size, self.size + 1, self.size + 2

    def assemble(self, turns: list[tuple[str, str]]) -> list[np.ndarray]:
        """The ids of every turn."""
        flat = [escape(part) for turn in turns for part in turn]
        encoded = [np.frombuffer(e, "<u4") for e in self.encoder.encode_all(flat)]
        mark = [np.array([m], "<u4") for m in (self.turn, self.sep, self.end)]
        return [np.concatenate([mark[0], encoded[2 * k], mark[1], encoded[2 * k + 1], mark[2]]) for k in range(len(turns))]

    def text(self, ids: np.ndarray) -> str:
        """Ids without markers as the escaped text they came from."""
        return self.encoder.tokenizer.decode(ids.tolist(), skip_special_tokens=False) if len(ids) else ""

    def parse(self, ids: np.ndarray) -> list[tuple[str, str]]:
        """Roles and texts of the turns in ``ids``."""
        starts, seps, ends = (np.flatnonzero(ids == m) for m in (self.turn, self.sep, self.end))
        return [(unescape(self.text(ids[a + 1 : b])), unescape(self.text(ids[b + 1 : c]))) for a, b, c in zip(starts, seps, ends)]

    def rendered(self, ids: np.ndarray) -> str:
        """All ids as text, markers spelled out."""
        cuts = np.flatnonzero(ids >= self.size)
        out, at = [], 0
        for k in cuts:
            out += [self.text(ids[at:k]), MARKERS[ids[k] - self.size]]
            at = k + 1
        return "".join(out) + self.text(ids[at:])

    def loss_mask(self, ids: np.ndarray) -> np.ndarray:
        """True for the content of turns of ``LOSS_ROLE``: inside by prefix sums, and of a turn with that role."""
        opened, closed = np.cumsum(ids == self.sep), np.cumsum(ids == self.end)
        inside = (opened > closed) & (ids != self.sep)
        turn_no = np.cumsum(ids == self.turn) - 1
        starts, seps = np.flatnonzero(ids == self.turn), np.flatnonzero(ids == self.sep)
        asked = np.array([unescape(self.text(ids[a + 1 : b])) == LOSS_ROLE for a, b in zip(starts, seps)], bool)
        return inside & asked[turn_no] if len(asked) else inside


def format_turns(conversations: DataFrame, tokenizer: str) -> DataFrame:
    """``conv_id, turn, ids, loss``: the token ids of every turn and which of them are learned from.

    The tokens of a conversation are those of its turns in order; ``conv_order`` carries role and text for ties.
    """
    kinds = {f.name: f.dataType.simpleString() for f in conversations.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = Template(tokenizer)
        for batch in batches:
            turns = list(zip(batch.column("role").to_pylist(), batch.column("text").to_pylist()))
            ids = template.assemble(turns)
            masks = [template.loss_mask(i) for i in ids]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"),
                    batch.column("turn"),
                    batch.column("role"),
                    pa.array([i.tobytes() for i in ids], pa.binary()),
                    pa.array([m.astype(np.uint8).tobytes() for m in masks], pa.binary()),
                ],
                names=["conv_id", "turn", "role", "ids", "loss"],
            )

    rows = conversations.select(
        conversations["conv_id"],
        conversations["turn"],
        F.coalesce(conversations["role"], F.lit("")).alias("role"),
        F.coalesce(conversations["text"], F.lit("")).alias("text"),
    )
    return rows.mapInArrow(run, f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, role string, ids binary, loss binary")


class _Digest:
    """What is known of one conversation while its turns go by."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.tokens, self.loss_chars, self.chars = conv_id, 0, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, template: Template, ids: np.ndarray, loss: np.ndarray) -> None:
        for role, text in template.parse(ids):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
        learned = unescape(template.text(ids[loss]))
        self.loss.update(learned.encode())
        self.loss_chars += len(learned)
        self.chars += len(template.rendered(ids))
        self.tokens += len(ids)

    def row(self) -> tuple:
        return self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.tokens


_ROW_NAMES = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens"]


def read_back(formatted: DataFrame, tokenizer: str) -> DataFrame:
    """Digests per conversation, decoded from the formatted tokens turn by turn in their order."""
    kind = formatted.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template, now, done = Template(tokenizer), None, []

        def emit():
            columns = list(zip(*done)) or [[]] * 7
            types = [conv_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=_ROW_NAMES)

        conv_type = None
        for batch in batches:
            conv_type = batch.schema.field("conv_id").type
            for conv, ids, loss in zip(batch.column("conv_id").to_pylist(), batch.column("ids").to_pylist(), batch.column("loss").to_pylist()):
                if now is None or conv != now.conv_id:
                    if now is not None:
                        done.append(now.row())
                    now = _Digest(conv)
                now.add(template, np.frombuffer(ids, "<u4"), np.frombuffer(loss, np.uint8).astype(bool))
            if done:
                yield emit()
                done.clear()
        if now is not None:
            done.append(now.row())
            yield emit()

    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "ids")
    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long"
    return ordered.mapInArrow(run, schema)
