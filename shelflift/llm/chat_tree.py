"""Chat formatting as a prefix tree: turns that conversations share at their beginning are written once.

* Template: ``<s>role``, a line break, the text, ``</s>`` and a line break; user texts stand in ``[INST]``, system texts in ``<<SYS>>``. In texts and roles a
  backslash is doubled and put into every control string after its first character, which can be undone and leaves no control string behind.
* A node of the tree is a turn after all turns before it, named by a digest chained over them. It belongs to the smallest conversation through it, so
  the nodes a conversation owns form one chain, and chains sorted by (-depth of branching, owner) along their path stand in depth-first order.
* Layout: tokens of all chains in that order, each once. Every node has the place of its first token, the position id of its first token (the tokens before it in
  the conversation), its loss range, and the intervals of places its tokens may attend to besides themselves: its ancestors'.
* Places are sums over a range-sorted table: within a range by a window, over ranges from one total each. No tree is gathered anywhere, however many conversations
  share a turn. A conversation is read as an ordered stream, turn by turn.

Turns are ordered by turn, then role and text. Null text or role: empty. Null conv_id: one conversation of that id. Repeated rows are turns
of their own. Equal conversations share all nodes. An empty table gives an empty layout; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from shelflift.llm.common import pin, small_batches

CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
WRAP = {"user": ("[INST] ", " [/INST]"), "system": ("<<SYS>>\n", "\n<</SYS>>")}
LOSS_ROLE = "assistant"
RANKS = "byte_bpe_50k.tiktoken"
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"<s>((?:[^\\\n]|\\.)*)\n(.*)</s>\n", re.DOTALL)


@dataclass
class Layout:
    nodes: DataFrame    # node, tree, depth, role, ids, place, position, n_tokens, loss_from, loss_to, attends
    members: DataFrame  # conv_id, depth, node


def escape(text: str) -> str:
    text = text.replace("\\", "\\\\")
    for control in CONTROLS:
        text = text.replace(control, control[0] + "\\" + control[1:])
    return text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def turn_parts(role: str, text: str) -> tuple[str, str, str]:
    """What stands before the text, the escaped text, and what stands behind it."""
    before, behind = WRAP.get(role, ("", ""))
    return f"<s>{escape(role)}\n".replace("\n", "\\\n", role.count("\n")) + before, escape(text), behind + "</s>\n"


def read_turn(formatted: str) -> tuple[str, str]:
    """(role, text) of one formatted turn."""
    role, body = _TURN.fullmatch(formatted).groups()
    role = unescape(role)
    before, behind = WRAP.get(role, ("", ""))
    return role, unescape(body[len(before):len(body) - len(behind)])


def _ranks() -> dict[bytes, int]:
    import public_tokenizers

    with open(public_tokenizers.path(RANKS), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _encoder():
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=_ranks(), special_tokens={}).encode_ordinary


_CHAINED = ("key string, conv_id string, depth int, node string, role string, ids binary, n_tokens int, loss_from int, loss_to int, position long")


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns, sorted within conversations, with node names, tokens and positions. Holds one batch and the state of one conversation."""
    encode, key, digest, depth, position = _encoder(), None, b"", 0, 0
    for batch in batches:
        out = []
        for k, conv, role, text in zip(*[batch.column(i).to_pylist() for i in range(4)]):
            if k != key:
                key, digest, depth, position = k, b"", 0, 0
            digest = hashlib.blake2b(digest + hashlib.sha256(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass")).digest(), digest_size=16).digest()
            before, body, behind = [encode(p) for p in turn_parts(role, text)]
            ids = np.array(before + body + behind, "<u4")
            loss = (len(before), len(before) + len(body)) if role == LOSS_ROLE else (0, 0)
            out.append((key, conv, depth, digest.hex(), role, ids.tobytes(), len(ids), *loss, position))
            depth, position = depth + 1, position + len(ids)
        yield pa.RecordBatch.from_pylist([dict(zip(_NAMES, row)) for row in out], _SCHEMA)


_SCHEMA = pa.schema([("key", pa.string()), ("conv_id", pa.string()), ("depth", pa.int32()), ("node", pa.string()), ("role", pa.string()),
                     ("ids", pa.binary()), ("n_tokens", pa.int32()), ("loss_from", pa.int32()), ("loss_to", pa.int32()), ("position", pa.int64())])
_NAMES = _SCHEMA.names


def layout(conversations: DataFrame) -> Layout:
    """The prefix tree of ``conversations`` (conv_id, turn, role, text); ids are unsigned 32 bit, little-endian."""
    small_batches(conversations.sparkSession)
    empty = F.lit("")
    kind = dict(conversations.dtypes)["conv_id"]
    rows = conversations.select(
        F.coalesce(F.concat(F.lit("#"), F.col("conv_id").cast("string")), empty).alias("key"), F.col("conv_id").cast("string").alias("conv_id"),
        F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"), "turn")
    turns = pin(rows.repartition("key").sortWithinPartitions("key", "turn", "role", "text").drop("turn").mapInArrow(_chain, _CHAINED), "turns")
    # Stored, so that the join below has an exchange of its own on both sides, of which Spark can split the parts of a common turn.
    owners = pin(turns.groupBy("node").agg(F.min("key").alias("owner")), "owners")
    owned = pin(turns.select("key", "depth", "node", "n_tokens", "position").join(owners, "node"), "owned")
    runs = owned.groupBy("key", "owner").agg(
        F.min("depth").alias("branch"), F.min("position").alias("from"), F.sum("n_tokens").cast("long").alias("n"))
    paths = runs.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("branch", "owner", "from", "n"))).alias("path"))
    chains = paths.filter(F.element_at("path", -1)["owner"] == F.col("key")).select(
        "key", "path", F.element_at("path", -1)["n"].alias("n"),
        F.transform("path", lambda p: F.struct((-p["branch"]).alias("b"), p["owner"].alias("o"))).alias("order"))
    ranged = pin(chains.repartitionByRange("order").withColumn("_part", F.spark_partition_id()), "chains")
    totals = ranged.groupBy("_part").agg(F.sum("n").alias("total"))
    bases = totals.select("_part", F.coalesce(F.sum("total").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    running = Window.partitionBy("_part").orderBy("order").rowsBetween(Window.unboundedPreceding, -1)
    placed = pin(ranged.withColumn("before", F.coalesce(F.sum("n").over(running), F.lit(0))).join(bases, "_part").select(
        "key", "path", (F.col("base") + F.col("before")).alias("place")), "placed")
    # A chain attends to each chain on its path, up to where the next one branches off.
    steps = placed.select("key", F.posexplode(F.transform("path", lambda p, i: F.struct(
        p["owner"].alias("owner"), (F.coalesce(F.get("path", i + 1)["from"], p["from"]) - p["from"]).alias("n")))).alias("i", "step"))
    seen = steps.filter("step.n > 0").join(placed.select(F.col("key").alias("owner"), "place"), F.col("step.owner") == F.col("owner"))
    ancestors = seen.groupBy("key").agg(F.array_sort(F.collect_list(F.struct(
        F.col("place").alias("start"), (F.col("place") + F.col("step.n")).alias("end")))).alias("ancestors"))
    chain = placed.select("key", "place", F.get("path", 0)["owner"].alias("tree"), F.element_at("path", -1)["from"].alias("from")).join(
        ancestors, "key", "left")
    own = turns.join(owned.filter("owner = key").select("key", "node"), ["key", "node"]).join(chain, "key")
    start = F.col("place") + F.col("position") - F.col("from")
    before = F.coalesce("ancestors", F.array().cast("array<struct<start:bigint,end:bigint>>"))
    nodes = own.select(
        "node", F.substring("tree", 2, 1 << 30).alias("tree"), "depth", "role", "ids", start.alias("place"), "position", "n_tokens",
        "loss_from", "loss_to", F.when(start > F.col("place"), F.concat(before, F.array(F.struct(
            F.col("place").alias("start"), start.alias("end"))))).otherwise(before).alias("attends"))
    return Layout(nodes, turns.select(F.col("conv_id").cast(kind).alias("conv_id"), "key", "depth", "node"))


_READ = "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(tree: Layout) -> DataFrame:
    """Each conversation's digests, decoded from the tokens of its nodes."""
    rows = tree.members.join(tree.nodes.select("node", "ids", "loss_from", "loss_to"), "node").select(
        "key", "depth", F.col("conv_id").cast("string").alias("conv_id"), "ids", "loss_from", "loss_to")
    kind = dict(tree.members.dtypes)["conv_id"]
    return rows.repartition("key").sortWithinPartitions("key", "depth").mapInArrow(_digests, _READ).withColumn(
        "conv_id", F.col("conv_id").cast(kind))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    token = {i: b for b, i in _ranks().items()}
    key, done, state = None, [], None
    names = [f.split()[0] for f in _READ.split(", ")]

    def close() -> None:
        if state:
            done.append((state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]))

    def flush() -> pa.RecordBatch:
        columns = list(zip(*done)) if done else [[] for _ in names]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)
        done.clear()
        return batch

    for batch in batches:
        for k, _, conv, ids, a, b in zip(*[batch.column(i).to_pylist() for i in range(6)]):
            if k != key:
                close()
                key, state = k, [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            pieces = [token[i] for i in np.frombuffer(ids, "<u4").tolist()]
            formatted = b"".join(pieces).decode("utf-8", "surrogatepass")
            role, text = read_turn(formatted)
            loss = unescape(b"".join(pieces[a:b]).decode("utf-8", "surrogatepass"))
            state[1] += 1
            state[2].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            state[3] += len(loss)
            state[4].update(loss.encode("utf-8", "surrogatepass"))
            state[5] += len(formatted)
        yield flush()
    close()
    yield flush()
