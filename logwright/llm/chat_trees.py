"""Chat formatting of reply trees.

Messages (conversation, id, parent id, role, text, score) form trees. Paths from each
leaf to its root are enumerated by iterative self-joins that double the distance each
time: after k joins a message knows its ancestor 2**k steps up and a leaf all its
ancestors closer than that, so a path of n messages takes log2 n rounds. Rounds
are joined on (conversation, message) - a long conversation spreads over all tasks -
and written to the shared folder, without texts. Branches are ranked by the sum of
their messages' scores (ties: smaller leaf id) and the best ``top`` per conversation,
or all, are formatted, each as one conversation.

Template. A turn is ``<|im_start|>role``, newline, text, ``<|im_end|>``, newline. Inside
roles and texts a backslash becomes two, and a backslash goes behind the first
character of every control string, so none is left; in roles also before a newline.
``read_back`` reverses this. The loss mask is a list of (start, end) character spans
of the formatted text: the escaped texts of assistant turns.

Null texts and roles count as empty, a null score as 0. A message whose parent does not
exist is a root. Repeated ids of a conversation count once (smallest role, text).
Messages in a cycle of parents hang on no root and raise an error. A null
conversation id is a conversation of its own. A message with a null id cannot be answered: it
is a leaf of its own under its parent (or a root without one), repeats included, its ``leaf``
is null, and it comes after the others where scores tie; ids from 2**62 on are
reserved for that. One conversation is one output row, so
its text is put together in one task; everything before that is spread.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .runtime import prepare, written

START, END = "<|im_start|>", "<|im_end|>"
#: Strings that tokenizers and chat templates read as control marks.
CONTROLS = (START, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
            "<pad>", "<unk>")
LEARNED_ROLE = "assistant"
#: First of the ids that messages without one get.
RESERVED = 1 << 62

_MARK = re.compile("(?=" + "|".join(map(re.escape, CONTROLS)) + ")(.)", re.S)
_TURN = re.compile(re.escape(START) + r"((?:[^\\\n]|\\.)*)\n(.*?)" + re.escape(END) + "\n", re.S)


def escape(text: str) -> str:
    return _MARK.sub(r"\1\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """Formatted conversation and the spans under the loss mask."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head = f"{START}{escape(role).replace(chr(10), chr(92) + chr(10))}\n"
        body = escape(text)
        if role == LEARNED_ROLE:
            spans.append((at + len(head), at + len(head) + len(body)))
        turn = f"{head}{body}{END}\n"
        out.append(turn)
        at += len(turn)
    return "".join(out), spans


def read_back(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at character {at}")
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return turns


# --- paths ----------------------------------------------------------------------

def _numbered(messages: DataFrame) -> DataFrame:
    """Messages with a non-null conversation key, one row per id; null ids get reserved ones.

    The result must be written, which fixes the ids that were given."""
    given = F.lit(RESERVED) + F.monotonically_increasing_id()
    m = messages.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("key"), "conv_id",
        F.coalesce(F.col("msg_id").cast("long"), given).alias("msg_id"), F.col("parent_id").cast("long").alias("parent_id"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    one = m.groupBy("key", "msg_id").agg(F.min(F.struct("role", "text", "parent_id", "score", "conv_id")).alias("m"))
    return one.select("key", "msg_id", "m.conv_id", "m.parent_id", "m.role", "m.text", "m.score")


def paths(messages: DataFrame) -> DataFrame:
    """(key, leaf, msg_id, above): every message of each root-to-leaf path.

    ``above`` counts the steps from the leaf. ``messages`` must be written.
    """
    ids = messages.select("key", "msg_id", "parent_id")
    known = ids.select("key", F.col("msg_id").alias("parent_id"))
    # links to existing parents: distance 1
    jump = written(ids.filter(F.col("parent_id").isNotNull()).join(known, ["key", "parent_id"], "left_semi")
                   .select("key", "msg_id", F.col("parent_id").alias("up")), "jump")
    leaves = ids.join(jump.select("key", F.col("up").alias("msg_id")), ["key", "msg_id"], "left_anti")
    rows = messages.count()
    reached = written(leaves.select("key", F.col("msg_id").alias("leaf"), "msg_id", F.lit(0).cast("long").alias("above")),
                      "paths")
    if rows and reached.isEmpty():
        raise ValueError("a cycle of parents hangs on no root")
    step = 1
    while not jump.isEmpty():
        if step >= max(rows, 2):
            raise ValueError("a cycle of parents hangs on no root")
        more = (reached.join(jump, ["key", "msg_id"])
                .select("key", "leaf", F.col("up").alias("msg_id"), (F.col("above") + step).alias("above")))
        reached = written(reached.unionByName(more), "paths")
        far = jump.select("key", F.col("msg_id").alias("up"), F.col("up").alias("up2"))
        jump = written(jump.join(far, ["key", "up"]).select("key", "msg_id", F.col("up2").alias("up")), "jump")
        step *= 2
    return reached


def format_trees(messages: DataFrame, top: int | None = 1) -> DataFrame:
    """Formatted conversations of reply trees: conv_id, leaf, score, formatted, loss_spans, n_turns.

    ``messages``: conv_id, msg_id, parent_id, role, text, score. ``top``: branches per
    conversation (None: all). Further columns are ignored.
    """
    prepare(messages.sparkSession)
    m = written(_numbered(messages), "messages")
    path = paths(m)
    if top is not None:
        total = (path.join(m.select("key", "msg_id", "score"), ["key", "msg_id"])
                 .groupBy("key", "leaf").agg(F.sum("score").alias("total")))
        w = Window.partitionBy("key").orderBy(F.desc("total"), "leaf")
        best = total.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)
        path = path.join(best.select("key", "leaf"), ["key", "leaf"], "left_semi")
    turns = path.join(m, ["key", "msg_id"])
    whole = turns.groupBy("key", "leaf").agg(
        F.first("conv_id").alias("conv_id"), F.sum("score").alias("score"),
        F.transform(F.sort_array(F.collect_list(F.struct((-F.col("above")).alias("at"), "role", "text"))),
                    lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))

    def run(batches):
        for b in batches:
            got = [format_turns([(t["role"], t["text"]) for t in row.as_py()]) for row in b.column("turns")]
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), b.column("leaf"), b.column("score"),
                 pa.array([g[0] for g in got], pa.string()),
                 pa.array([[{"start": a, "end": z} for a, z in g[1]] for g in got],
                          pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                names=["conv_id", "leaf", "score", "formatted", "loss_spans"])
    leaf = F.when(F.col("leaf") < RESERVED, F.col("leaf")).alias("leaf")
    return whole.select("conv_id", leaf, "score", "turns").mapInArrow(
        run, "conv_id long, leaf long, score double, formatted string, "
             "loss_spans array<struct<start:long,end:long>>")


def digests(formatted: DataFrame) -> DataFrame:
    """What a reader of the formatted conversations gets: turns and loss text, as digests."""
    def run(batches):
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        for b in batches:
            out = [[] for _ in range(5)]
            for text, spans in zip(b.column("formatted").to_pylist(), b.column("loss_spans").to_pylist()):
                turns = read_back(text)
                loss = "".join(unescape(text[s["start"]:s["end"]]) for s in spans)
                row = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(text))
                for c, v in zip(out, row):
                    c.append(v)
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), *(pa.array(c, k) for c, k in zip(out, kinds))],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
    return formatted.select("conv_id", "formatted", "loss_spans").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
             "formatted_chars long")


def linear(conversations: DataFrame) -> DataFrame:
    """Conversations of turns as reply trees without branches: each turn answers the one before.

    Rows are taken by turn (null first), then role and text; repeated rows are turns of
    their own.
    """
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    at = F.row_number().over(Window.partitionBy(key).orderBy("turn", "role", "text"))
    return (conversations.select("conv_id", at.alias("msg_id"), "role", "text")
            .withColumn("parent_id", F.when(F.col("msg_id") > 1, F.col("msg_id") - 1))
            .withColumn("score", F.lit(0.0)))
