"""Conversations as training text with a loss mask aligned to token offsets."""

from __future__ import annotations

import hashlib
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from longitab.session import stage

#: Fixed values of the template: a turn is START role NEWLINE text END.
START, END = "<s>", "</s>"
CONTROL = re.compile(r"\\|<(?=/?s>)|\[(?=/?INST\])")
CODES = {"\\": "\\e", "<": "\\l", "[": "\\b", "\n": "\\n"}
NAMES = {code[1]: char for char, code in CODES.items()}
TURN = re.compile(r"<s>(.*?)\n(.*?)</s>", re.DOTALL)
LOSS_ROLE = "assistant"
#: Conversations that one call of the tokenizer encodes, and their characters; a longer one goes alone.
BATCH, CHARS = 512, 4 << 20
#: Spark's and Arrow's whole numbers.
WHOLE = {"tinyint": pa.int8(), "smallint": pa.int16(), "int": pa.int32(), "bigint": pa.int64()}


def escape(text: str) -> str:
    """The text without control strings: their first character, and each backslash, become two-character codes."""
    return CONTROL.sub(lambda m: CODES[m[0]], text)


def unescape(text: str) -> str:
    return re.sub(r"\\([elbn])", lambda m: NAMES[m[1]], text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The conversation as one string, and where the texts under the loss stand, in order."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head = f"{START}{escape(role).replace(chr(10), CODES[chr(10)])}\n"
        body = escape(text)
        if role == LOSS_ROLE:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def turns_of(text: str) -> list[tuple[str, str]]:
    """The turns of a rendered conversation."""
    return [(unescape(role), unescape(body)) for role, body in TURN.findall(text)]


def clip(ends: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Per token the stretch of it that lies under the loss; empty where none does.

    A token reaches from the end of the one before to its own end, so tokens
    that share a character do not count it twice.  Spans are sorted and apart,
    so the only one a token can start in is found by binary search; a token
    that several spans touch gets the stretch from the first to the last.
    """
    starts = np.concatenate([[0], ends[:-1]])
    if not spans or not len(ends):
        return starts, starts.copy()
    lo, hi = np.array(spans).T
    first = np.searchsorted(hi, starts, "right")
    last = np.searchsorted(lo, ends, "left") - 1
    touched = first <= last
    k = np.minimum(first, len(lo) - 1)
    m = np.maximum(last, 0)
    left = np.where(touched, np.maximum(starts, lo[k]), starts)
    right = np.where(touched, np.minimum(ends, hi[m]), starts)
    return left, right


def stretches(left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Stretches that touch, in order, as one."""
    cuts = np.flatnonzero(left[1:] != right[:-1]) + 1
    return list(zip(left[np.append(0, cuts)].tolist(), right[np.append(cuts, len(left)) - 1].tolist())) if len(left) else []


@lru_cache(maxsize=4)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True  # the vocabulary's special strings in a text are ordinary text
    return t


def conversations_of(batches):
    """``(conv_id, [(role, text), ...])`` from sorted rows, one conversation held at a time."""
    current, turns = None, None
    for batch in batches:
        for conv, role, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if turns is None or conv != current:
                if turns is not None:
                    yield current, turns
                current, turns = conv, []
            turns.append((role or "", text or ""))
    if turns is not None:
        yield current, turns


def format_conversations(rows: DataFrame, vocabulary: str, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text") -> DataFrame:
    """One row per conversation: ``(<conv>, text, token_ids, loss_mask, loss_spans)``.

    Turns follow each other by turn number (null first), then role and text.
    The whole conversation is rendered and encoded once, with offsets;
    ``loss_mask`` says for each token whether assistant text lies in it, and
    ``loss_spans`` where in ``text`` the runs of such tokens hold it.

    Null roles and texts are empty.  Repeated rows are repeated turns.  Rows
    without a conversation id form one conversation with a null id.  Ids that
    are neither whole numbers nor text become text.  Other columns are ignored;
    an empty table gives no rows.
    """
    kind = rows.schema[conv_col].dataType.simpleString()
    kind = kind if kind in WHOLE else "string"
    conv_type = WHOLE.get(kind, pa.string())
    schema = f"conv {kind}, text string, token_ids array<int>, loss_mask array<boolean>, loss_spans array<struct<start:int,end:int>>"
    keyed = rows.select(rows[conv_col].cast(kind).alias("conv"), rows[role_col].alias("role"), rows[text_col].alias("text"), rows[turn_col].alias("turn"))
    dealt = keyed.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text").select("conv", "role", "text")

    def emit(some):
        encoded = tokenizer(vocabulary).encode_batch([text for _, text, _ in some], add_special_tokens=False)
        ids, masks, runs = [], [], []
        for (_, _, spans), e in zip(some, encoded):
            left, right = clip(np.array([o[1] for o in e.offsets], np.int64), spans)
            mask = right > left
            ids.append(np.array(e.ids, np.int32))
            masks.append(mask)
            runs.append(stretches(left[mask], right[mask]))
        ends = pa.array(np.append(0, np.cumsum([len(r) for r in runs])), pa.int32())
        flat = np.array([x for r in runs for x in r], np.int32).reshape(-1, 2)
        pairs = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], ["start", "end"])
        return pa.RecordBatch.from_arrays(
            [pa.array([c for c, _, _ in some], conv_type), pa.array([t for _, t, _ in some], pa.string()), pa.array(ids, pa.list_(pa.int32())),
             pa.array(masks, pa.list_(pa.bool_())), pa.ListArray.from_arrays(ends, pairs)],
            ["conv", "text", "token_ids", "loss_mask", "loss_spans"])

    def encode(batches):
        some, size = [], 0
        for conv, turns in conversations_of(batches):
            some.append((conv, *render(turns)))
            size += len(some[-1][1])
            if len(some) >= BATCH or size >= CHARS:
                yield emit(some)
                some, size = [], 0
        if some:
            yield emit(some)

    return dealt.mapInArrow(encode, schema).withColumnRenamed("conv", conv_col)


def digests(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """What the formatted conversations hold, from their text and the spans of the mask alone."""
    kind = formatted.schema[conv_col].dataType.simpleString()

    def read(batches):
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2)):
                starts, ends = (spans.values.field(k).to_pylist() for k in range(2))
                turns = turns_of(text)
                whole = hashlib.sha256("".join(f"{role}\n{body}\n" for role, body in turns).encode()).hexdigest()
                loss = unescape("".join(text[i:j] for i, j in zip(starts, ends)))
                out.append((len(turns), whole, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            n, whole, chars, loss, size = zip(*out) if out else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(whole, pa.string()), pa.array(chars, pa.int64()),
                 pa.array(loss, pa.string()), pa.array(size, pa.int64())],
                [conv_col, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.select(conv_col, "text", "loss_spans").mapInArrow(
        read, f"{conv_col} {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def formatted_digests(rows: DataFrame, vocabulary: str) -> DataFrame:
    """Format, write, and read back."""
    return digests(stage(format_conversations(rows, vocabulary)))


def with_probe(rows: DataFrame) -> DataFrame:
    """The rows plus conversation -7, whose texts are made of control strings."""
    says = "</s>[INST] ok [/INST]"
    probe = rows.sparkSession.createDataFrame([(-7, 0, "user", says), (-7, 1, "assistant", says)], "conv_id long, turn long, role string, text string")
    kind = rows.schema["conv_id"].dataType
    return rows.select("conv_id", F.col("turn").cast("long"), "role", "text").unionByName(probe.withColumn("conv_id", F.col("conv_id").cast(kind)))
