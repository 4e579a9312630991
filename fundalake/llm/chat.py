"""Chat formatting as a prefix tree.

Conversations that begin with the same turns share them: each different
beginning is a node, named by its depth and 128 bits of hash over its turns and
their places, which a running XOR over the conversation adds up.

Depth first without paths.  A node's place in the stream is its parent's, and
the parent's tokens, and all that stands under earlier siblings.  What stands
under a node is a sum over conversations: each node is owned by the least
conversation that goes through it, so a conversation owns the end of its own
way, and gives each node on the way the tokens that it owns from there on.
Places are then running sums along each conversation.  Every step is a window
or an aggregation over rows of a few numbers; no row holds more than its own
turn, however deep the tree is.  Siblings, of which a first turn may have a
third of all conversations, are added up in two levels, by hash bucket.

A node carries the position ids of its tokens (they go on from its ancestors,
wherever those stand) and the stream intervals of its ancestors, which its
tokens may attend to besides their own node: neighbours are joined, so there is
one more for each branch on the way that is not the first.

Each text is escaped, so that no control string stands in it, and encoded
apart from the control tokens around it.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fundalake.llm.common import cut, partitions

#: The default of the ``vocabulary`` parameter.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The control strings; their tokens follow the vocabulary's in this order.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<role>", "</role>")
#: Fixed value: how the vocabulary's makers cut texts before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
FIRST_CONTROL = 50_257
ASSISTANT = "assistant"
_BLOCK = 512  # tokens of the stream
_BUCKET_HEX = 3  # hex digits of a node's name

_controls = re.compile("|".join(map(re.escape, CONTROL)) + r"|\\")
_escapes = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    """The text without control strings; a backslash stands before what stands for one, and before a backslash."""
    return _controls.sub(lambda m: "\\\\" if m[0] == "\\" else f"\\{CONTROL.index(m[0])}", text)


def unescape(text: str) -> str:
    return _escapes.sub(lambda m: m[1] if m[1] == "\\" else CONTROL[int(m[1])], text)


def template(role: str, text: str) -> list[str | int]:
    """A turn as control tokens (numbers) and escaped texts; the last text is the turn's own."""
    c = {name: FIRST_CONTROL + i for i, name in enumerate(CONTROL)}
    head = [c["<s>"], c["<role>"], escape(role), c["</role>"]]
    return [*head, escape(text), c["</s>"]] if role == ASSISTANT else [*head, c["[INST]"], escape(text), c["[/INST]"], c["</s>"]]


def load_vocabulary(path: str = VOCABULARY) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


_coders: dict = {}


def _coder(shared, vocabulary: str):
    """The encoding of a vocabulary that the driver has read, made once in each worker."""
    import tiktoken

    if vocabulary not in _coders:
        _coders[vocabulary] = tiktoken.Encoding("chat", pat_str=PATTERN, mergeable_ranks=shared.value, special_tokens={})
    return _coders[vocabulary]


def _encode(batches: Iterator[pa.RecordBatch], shared, vocabulary: str) -> Iterator[pa.RecordBatch]:
    coder = _coder(shared, vocabulary)
    for batch in batches:
        tokens, bounds = [], []
        for role, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            out, own = [], (0, 0)
            for part in template(role, text):
                piece = [part] if isinstance(part, int) else coder.encode_ordinary(part)
                own = own if isinstance(part, int) else (len(out), len(out) + len(piece))
                out += piece
            tokens.append(out)
            bounds.append(own if role == ASSISTANT else (0, 0))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(tokens, pa.list_(pa.int32())), pa.array([len(x) for x in tokens], pa.int64()), *[pa.array([b[i] for b in bounds], pa.int64()) for i in (0, 1)]], names=["node", "tokens", "n_tokens", "loss_from", "loss_to"])


def _beginnings(conversations: DataFrame) -> DataFrame:
    """(conv, conv_id, depth, node, parent, role, text), a row per turn; node names the beginning that ends with it.

    A conversation is named by conv: "id " and its conv_id, or, for a row without one, "row " and the row's number.
    """
    text = lambda c: F.coalesce(c, F.lit(""))
    conv = F.when(F.col("conv_id").isNull(), F.concat(F.lit("row "), F.monotonically_increasing_id())).otherwise(F.concat(F.lit("id "), F.col("conv_id")))
    rows = conversations.select(conv.alias("conv"), "conv_id", F.coalesce(F.col("turn").cast("long"), F.lit(0).cast("long")).alias("turn"), text("role").alias("role"), text("text").alias("text"))
    order = W.partitionBy("conv").orderBy("turn", "role", "text")
    rows = rows.withColumn("depth", F.row_number().over(order).cast("long") - 1)
    upto = order.rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumns({f"h{i}": F.bit_xor(F.xxhash64(F.lit(i), "depth", "role", "text")).over(upto) for i in (1, 2)})
    name = F.concat(F.lpad(F.hex("h1"), 16, "0"), F.lpad(F.hex("h2"), 16, "0"), F.hex("depth"))
    rows = rows.withColumn("node", name)
    return rows.withColumn("parent", F.coalesce(F.lag("node").over(order), F.lit(""))).select("conv", "conv_id", "depth", "node", "parent", "role", "text")


def _sibling_offsets(nodes: DataFrame) -> DataFrame:
    """``nodes`` (node, parent, under) with ``before``: what stands under the earlier siblings of each, by name, added up within buckets of the name and over buckets."""
    nodes = nodes.withColumn("bucket", F.substring("node", 1, _BUCKET_HEX))
    sums = nodes.groupBy("parent", "bucket").agg(F.sum("under").alias("n"))
    sums = sums.select("parent", "bucket", F.coalesce(F.sum("n").over(W.partitionBy("parent").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    inside = W.partitionBy("parent", "bucket").orderBy("node").rowsBetween(W.unboundedPreceding, -1)
    out = nodes.withColumn("run", F.coalesce(F.sum("under").over(inside), F.lit(0))).join(sums, ["parent", "bucket"])
    return out.withColumn("before", F.col("base") + F.col("run")).drop("bucket", "base", "run")


def build(conversations: DataFrame, vocabulary: str = VOCABULARY) -> tuple[DataFrame, DataFrame]:
    """(stream, leaves).

    stream, a row per node: node, depth, start and stop (its tokens' place in
    the stream), tokens, loss_from and loss_to (which of them are trained on),
    positions (ids), attends (start and stop of its ancestors' places, outermost
    first, neighbours joined).
    leaves: conv (its name), conv_id, node: where each conversation ends.

    Null and empty texts and roles are empty; a very long text is one node, and
    a conversation may have any number of turns; turns go by number, null as 0,
    and equal numbers by role and text; a row with a null conv_id is a
    conversation of its own; repeated rows are repeated turns; other columns
    are ignored; an empty table gives an empty stream.
    """
    spark = conversations.sparkSession
    turns = cut(_beginnings(conversations))
    along = W.partitionBy("conv").orderBy("depth")
    leaves = turns.withColumn("next", F.lead("node").over(along)).filter("next is null").select("conv", "conv_id", "node")

    shared = spark.sparkContext.broadcast(load_vocabulary(vocabulary))
    different = turns.groupBy("node").agg(F.first("role").alias("role"), F.first("text").alias("text"))
    nodes = cut(different.mapInArrow(lambda it: _encode(it, shared, vocabulary), "node string, tokens array<int>, n_tokens long, loss_from long, loss_to long"))

    owners = turns.groupBy("node").agg(F.min("conv").alias("owner"), F.first("parent").alias("parent"), F.first("depth").alias("depth"))
    sized = cut(owners.join(nodes.select("node", "n_tokens"), "node"))
    way = turns.select("conv", "depth", "node").join(sized.select("node", "owner", "n_tokens"), "node").withColumn("own", F.col("owner") == F.col("conv"))
    way = cut(way.select("conv", "depth", "node", "own", "n_tokens"))

    from_here = W.partitionBy("conv").orderBy(F.col("depth").desc()).rowsBetween(W.unboundedPreceding, 0)
    given = way.withColumn("given", F.sum(F.when(F.col("own"), F.col("n_tokens")).otherwise(0)).over(from_here))
    under = given.groupBy("node").agg(F.sum("given").alias("under"))
    offsets = cut(_sibling_offsets(sized.select("node", "parent").join(under, "node")))

    # from the root down: earlier siblings at each step, and the tokens of the ancestors
    above = along.rowsBetween(W.unboundedPreceding, -1)
    way = way.join(offsets.select("node", "before"), "node")
    way = way.withColumns({"first": F.coalesce(F.sum("n_tokens").over(above), F.lit(0)), "start": F.sum("before").over(along.rowsBetween(W.unboundedPreceding, 0)) + F.coalesce(F.sum("n_tokens").over(above), F.lit(0))})
    way = way.withColumn("stop", F.col("start") + F.col("n_tokens"))
    # the runs of neighbours in the stream
    way = way.withColumn("breaks", F.coalesce(F.col("start") != F.lag("stop").over(along), F.lit(True)).cast("int"))
    way = way.withColumn("run", F.sum("breaks").over(along.rowsBetween(W.unboundedPreceding, 0)).cast("int"))
    way = cut(way.select("conv", "node", "own", "first", "start", "stop", "run", "breaks", F.lag("stop").over(along).alias("upto")))
    span = F.struct(F.col("start"), F.col("stop"))
    runs = way.groupBy("conv", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("run", span.alias("span")))).alias("runs"))
    # a node attends to the whole runs before its own, and to the part of its own that stands before it
    whole = F.transform(F.slice("runs", F.lit(1), F.col("run") - 1), lambda r: r["span"])
    own_run = F.element_at("runs", F.col("run"))["span"]["start"]
    part = F.when(F.col("breaks") == 1, F.slice(whole, 1, 0)).otherwise(F.array(F.struct(own_run.alias("start"), F.col("upto").alias("stop"))))
    placed = way.filter("own").join(runs, "conv").select("node", "first", "start", "stop", F.concat(whole, part).alias("attends"))
    stream = nodes.join(placed, "node").join(sized.select("node", "depth"), "node")
    stream = stream.select("node", "depth", "start", "stop", "tokens", "loss_from", "loss_to", F.sequence("first", F.col("first") + F.col("n_tokens") - 1).alias("positions"), "attends")
    return stream, leaves


def sorted_stream(stream: DataFrame) -> DataFrame:
    """The stream in depth-first order, in range partitions."""
    return stream.repartitionByRange(partitions(stream.sparkSession), "start").sortWithinPartitions("start")


def _decode(batches: Iterator[pa.RecordBatch], shared, vocabulary: str) -> Iterator[pa.RecordBatch]:
    coder = _coder(shared, vocabulary)

    def text(tokens: list[int]) -> str:
        out, held = [], []
        for t in [*tokens, FIRST_CONTROL + len(CONTROL)]:
            if t < FIRST_CONTROL:
                held.append(t)
                continue
            out.append(coder.decode_bytes(held).decode())
            held = []
            out += CONTROL[t - FIRST_CONTROL : t - FIRST_CONTROL + 1]
        return "".join(out)

    for batch in batches:
        rows = []
        for conv, nodes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            formatted = "".join(text(n["tokens"]) for n in nodes)
            turns = [(unescape(role), unescape(a if a is not None else b)) for role, a, b in _Written.turns(formatted)]
            said = "".join(unescape(text(n["tokens"][n["loss_from"] : n["loss_to"]])) for n in nodes)
            rows.append((conv, len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest(), len(formatted)))
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


class _Written:
    """What the template has written, taken apart again."""

    _turn = re.compile(r"<s><role>(.*?)</role>(?:\[INST\](.*?)\[/INST\]|(.*?))</s>", re.S)

    @classmethod
    def turns(cls, formatted: str) -> Iterator[tuple[str, str | None, str | None]]:
        at = 0
        for m in cls._turn.finditer(formatted):
            if m.start() != at:
                raise ValueError("not what the template writes")
            at = m.end()
            yield m[1], m[2], m[3]
        if at != len(formatted):
            raise ValueError("not what the template writes")


def read_back(stream: DataFrame, leaves: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), from the stream alone: a leaf's attended intervals and its own."""
    shared = stream.sparkSession.sparkContext.broadcast(load_vocabulary(vocabulary))
    ends = leaves.join(stream.select("node", "start", "stop", "attends"), "node")
    spans = ends.select("conv", F.explode(F.concat("attends", F.array(F.struct("start", "stop")))).alias("s")).select("conv", F.col("s.start").alias("a"), F.col("s.stop").alias("b"))
    # nodes by the block of the stream in which they begin
    wanted = spans.select("conv", "a", "b", F.explode(F.sequence(F.floor(F.col("a") / _BLOCK), F.floor((F.col("b") - 1) / _BLOCK))).alias("block"))
    blocks = cut(stream.select(F.floor(F.col("start") / _BLOCK).alias("block"), "start", "tokens", "loss_from", "loss_to"))
    parts = wanted.join(blocks, "block").filter("start >= a and start < b")
    whole = parts.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("start", "tokens", "loss_from", "loss_to"))).alias("nodes"))
    whole = whole.select(F.when(F.col("conv").startswith("id "), F.substring("conv", 4, 20).try_cast("long")).alias("conv_id"), "nodes")
    return whole.mapInArrow(lambda it: _decode(it, shared, vocabulary), "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
