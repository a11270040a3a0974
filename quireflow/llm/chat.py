"""Chat formatting from reply trees.

Messages (tree, node, parent, role, text, score) form trees. Iterative self-joins double the stretch
of ancestors that each node knows, with the sum of their scores, until all reach their root; so paths
of n messages take log2(n) joins. Branches (leaves) of a tree rank by the mean score of their path,
then its length, then the smaller leaf; the messages of the chosen paths come from the same jump
tables. Each path is formatted as one conversation:

    <|im_start|>role, line end, text <|im_end|>, line end

In texts and roles a ``<`` that backslashes and a ``|`` follow gets one more backslash, so no control string
can occur in them; reading back takes it away. Line ends and backslashes in roles are escaped too.
Assistant texts are under the loss mask, as spans of code points of the formatted text.

A conversation of more than ``PART`` characters comes in several parts, in order, cut between
turns; so no row grows with a conversation. Formatting and reading back stream over sorted rows and
hold one part. A digest over a whole conversation is made by one task, as SHA-256 allows no other
way, but without holding the conversation.

Edge cases: null texts and roles are empty; null turns come first; rows that tie in turn come in the order of a hash of role and
text, repeated rows stay; a null conversation id is a conversation of its own; a parent that is
missing or in another tree makes its child a root; messages whose replies run in a circle are on no
path; of rows that repeat a node the smallest (tree, parent, role, text, score) stands; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

START, END = "<|im_start|>", "<|im_end|>"
TRAINED = "assistant"
PART = 1 << 18

_ESCAPE, _UNESCAPE = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def from_turns(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Messages of linear conversations: each replies to the one before it by turn.

    Nodes are numbered along a range partitioning by conversation and turn, which splits a
    conversation that holds much of the table.
    """
    text, role = F.coalesce(F.col(text_col), F.lit("")), F.coalesce(F.col(role_col), F.lit(""))
    rows = rows.select(F.col(conv_col).alias("tree"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    order = ["tree", "turn", "role", "text"]
    dealt = cut(rows.repartitionByRange("tree", "turn", F.xxhash64("role", "text")).sortWithinPartitions("tree", "turn", F.xxhash64("role", "text"), *order[2:]).withColumn("part", F.spark_partition_id()))
    total, before = 0, []
    for part, n in sorted((r[0], r[1]) for r in dealt.groupBy("part").count().collect()):  # one row for each partition
        before.append((part, total))
        total += n
    offsets = rows.sparkSession.createDataFrame(before, "part int, before long")
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    node = F.col("before") + F.col("place")
    placed = dealt.withColumn("place", place).join(F.broadcast(offsets), "part")
    return cut(placed.select("tree", node.alias("node"), (node - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score")))


def best_paths(messages: DataFrame, keep: int = 1) -> DataFrame:
    """``tree, path, depth, node``: the messages of the ``keep`` best branches of each tree; ``path`` is the leaf."""
    one = messages.groupBy("node").agg(F.min(F.struct("tree", "parent", "score")).alias("m")).select("node", "m.*")
    parents = one.select(F.col("node").alias("parent"), F.col("tree").alias("other"), F.lit(True).alias("there"))
    up = F.when(F.col("there") & F.col("other").eqNullSafe(F.col("tree")), F.col("parent"))
    linked = one.join(parents, "parent", "left")
    jump = cut(linked.select("node", "tree", up.alias("up"), F.coalesce("score", F.lit(0.0)).alias("total"), F.lit(1).cast("long").alias("n")))
    leaves = jump.join(jump.where("up IS NOT NULL").select(F.col("up").alias("node")).distinct(), "node", "left_anti").select("node")
    steps, count = [jump], jump.count()
    while (1 << len(steps)) <= 2 * count and not steps[-1].where("up IS NOT NULL").isEmpty():
        last = steps[-1]
        # only nodes that have not reached their root go on; the others' sums stand
        far = last.select(F.col("node").alias("up"), F.col("up").alias("up2"), F.col("total").alias("total2"), F.col("n").alias("n2"))
        going = last.where("up IS NOT NULL").join(far, "up").select("node", "tree", F.col("up2").alias("up"), (F.col("total") + F.col("total2")).alias("total"), (F.col("n") + F.col("n2")).alias("n"))
        steps.append(cut(going.union(last.where("up IS NULL").select("node", "tree", "up", "total", "n"))))
    ends = steps[-1].where("up IS NULL").join(leaves, "node", "left_semi")
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc(F.col("total") / F.col("n")), F.desc("n"), "node"))
    chosen = ends.withColumn("r", rank).where(F.col("r") <= keep).select("tree", F.col("node").alias("path"), "n", "node", F.lit(0).cast("long").alias("up_by"))
    # every distance to an ancestor is one sum of powers of two, so each ancestor comes once
    for k, step in enumerate(steps):
        hop = step.where("up IS NOT NULL").select("node", "up")
        chosen = chosen.union(chosen.join(hop, "node").select("tree", "path", "n", F.col("up").alias("node"), F.col("up_by") + (1 << k)))
        if k < len(steps) - 1:
            chosen = cut(chosen)
    return chosen.select("tree", "path", (F.col("n") - F.col("up_by")).alias("depth"), "node")


def _sorted_turns(messages: DataFrame, paths: DataFrame) -> DataFrame:
    """The turns of each path, a path in one partition and in order."""
    one = messages.groupBy("node").agg(F.min(F.struct("role", "text")).alias("m")).select("node", "m.*")
    rows = paths.join(one, "node").select("tree", "path", "depth", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.repartition("path").sortWithinPartitions("path", "depth").select("tree", "path", "role", "text")


def formatted_parts(turns: Iterable[tuple]) -> Iterator[tuple]:
    """(tree, path, part, formatted, loss spans) of sorted (tree, path, role, text)."""
    key, part, text, size, loss = None, 0, [], 0, []
    for tree, path, role, body in turns:
        if key is not None and (key != (tree, path) or size >= PART):
            yield *key, part, "".join(text), loss
            part, text, size, loss = (part + 1 if key == (tree, path) else 0), [], 0, []
        key = (tree, path)
        head, body = f"{START}{escape_role(role)}\n", escape(body)
        if role == TRAINED:
            loss.append((size + len(head), size + len(head) + len(body)))
        text += [head, body, END, "\n"]
        size += len(head) + len(body) + len(END) + 1
    if key is not None:
        yield *key, part, "".join(text), loss


def digests(parts: Iterable[tuple]) -> Iterator[tuple]:
    """(tree, path, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of conversations' parts in order."""
    key, n, turns, loss_n, loss, chars = None, 0, None, 0, None, 0
    for tree, path, _, text, spans in parts:
        if key != (tree, path):
            if key is not None:
                yield *key, n, turns.hexdigest(), loss_n, loss.hexdigest(), chars
            key, n, turns, loss_n, loss, chars = (tree, path), 0, hashlib.sha256(), 0, hashlib.sha256(), 0
        chars += len(text)
        at = 0
        for m in _TURN.finditer(text):
            if m.start() != at:
                raise ValueError(f"text between turns in conversation {tree}")
            at = m.end()
            n += 1
            turns.update(f"{unescape_role(m[1])}\n{unescape(m[2])}\n".encode("utf-8", "surrogatepass"))
        if at != len(text):
            raise ValueError(f"an unfinished turn in conversation {tree}")
        for start, end in spans:
            shown = unescape(text[start:end])
            loss_n += len(shown)
            loss.update(shown.encode("utf-8", "surrogatepass"))
    if key is not None:
        yield *key, n, turns.hexdigest(), loss_n, loss.hexdigest(), chars


def _rows(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            yield from zip(*(batch.column(c).slice(at, 256).to_pylist() for c in columns), strict=True)


def _batches(rows: Iterable[tuple], schema: pa.Schema, weight: int | None = None) -> Iterator[pa.RecordBatch]:
    """Record batches of up to 512 rows, fewer where the texts in column ``weight`` fill a part."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[weight]) if weight is not None else 0
        if len(held) >= 512 or size >= PART:
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in held], f.type) for k, f in enumerate(schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in held], f.type) for k, f in enumerate(schema)], schema=schema)


def _schemas(messages: DataFrame) -> tuple[str, str]:
    tree = messages.schema["tree"].dataType.simpleString()
    return (
        f"tree {tree}, path long, part int, formatted string, loss array<struct<start:int,end:int>>",
        f"tree {tree}, path long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


def format_paths(messages: DataFrame, paths: DataFrame) -> DataFrame:
    """``tree, path, part, formatted, loss``: conversations in parts; ``loss`` are spans of code points in the part.

    Rows of a path lie in one partition, sorted by part.
    """
    schema = _schemas(messages)[0]
    arrow = _arrow(schema)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = formatted_parts(_rows(batches, ("tree", "path", "role", "text")))
        shaped = ((t, p, k, f, [{"start": a, "end": b} for a, b in loss]) for t, p, k, f, loss in parts)
        return _batches(shaped, arrow, 3)

    return _sorted_turns(messages, paths).mapInArrow(over, schema)


def read_back(messages: DataFrame, paths: DataFrame) -> DataFrame:
    """What the formatted conversations say, parsed again from their parts as these are made.

    ``tree, path, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``.
    """
    schema = _schemas(messages)[1]
    arrow = _arrow(schema)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(digests(formatted_parts(_rows(batches, ("tree", "path", "role", "text")))), arrow)

    return _sorted_turns(messages, paths).mapInArrow(over, schema)
