"""Exact deduplication by owners in compressed radix tries."""

import hashlib
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import functions as F

from tidegrid.llm.support import batch, id_and_text, raw


class Node:
    __slots__ = ("edges", "owner")

    def __init__(self):
        self.edges = {}
        self.owner = None


def shared_prefix(one, two):
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(one), len(two))
    while low < high:
        middle = (low + high + 1) // 2
        if one[low:middle] == two[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class RadixTrie:
    """Byte strings in a Patricia trie: an edge holds as many bytes as no other string divides."""

    def __init__(self):
        self.root = Node()

    def node(self, key):
        """The terminal node of a byte string, made if it is new."""
        node, at = self.root, 0
        while at < len(key):
            edge = node.edges.get(key[at])
            if edge is None:
                leaf = Node()
                node.edges[key[at]] = (key[at:], leaf)
                return leaf
            label, below = edge
            if not key.startswith(label, at):
                cut = shared_prefix(label, key[at : at + len(label)])
                middle = Node()
                middle.edges[label[cut]] = (label[cut:], below)
                node.edges[key[at]] = (label[:cut], middle)
                label, below = label[:cut], middle
            node, at = below, at + len(label)
        return node

    def owners(self):
        """Every owner that a terminal node holds."""
        open_nodes = [self.root]
        while open_nodes:
            node = open_nodes.pop()
            if node.owner is not None:
                yield node.owner
            open_nodes.extend(below for _, below in node.edges.values())


OWNERS = "ref long, bytes long, head long, body binary, sha string, members long, best long"
MEMBERS = "id long, ref long, sha string"
RESULTS = "ref long, sha string, keep_id long, group_size long"


def _better(best, other, largest):
    if best is None or other is None:
        return other if best is None else best
    return max(best, other) if largest else min(best, other)


def _block(ids, texts, largest):
    """The tries of one block of documents: a subtree for each length and content hash."""
    subtrees, places = {}, []
    for id, text in zip(ids, texts):
        body = text.lower()  # of bytes: A-Z only
        digest = hashlib.sha256(body)
        key = len(body), int.from_bytes(digest.digest()[:8], "big", signed=True)
        trie = subtrees.get(key)
        if trie is None:
            trie = subtrees[key] = RadixTrie()
        node = trie.node(body)
        if node.owner is None:
            node.owner = [id, key, body, digest.hexdigest(), 0, None]
        owner = node.owner
        owner[0] = _better(owner[0], id, False)
        owner[4] += 1
        owner[5] = _better(owner[5], id, largest)
        places.append(owner)
    return subtrees, places


def _owners(largest):
    def run(batches):
        for rows in batches:
            subtrees, _ = _block(rows.column(0).to_pylist(), raw(rows.column(1)), largest)
            owners = [o for trie in subtrees.values() for o in trie.owners()]
            if owners:
                yield batch(OWNERS, *zip(*[(ref, key[0], key[1], body, sha, n, best) for ref, key, body, sha, n, best in owners]))

    return run


def _members(largest):
    def run(batches):
        for rows in batches:
            ids = rows.column(0).to_pylist()
            _, places = _block(ids, raw(rows.column(1)), largest)
            if places:
                yield batch(MEMBERS, ids, [o[0] for o in places], [o[3] for o in places])

    return run


def _merge(largest):
    """Owners of all blocks, sorted by length and hash: a subtree is complete, and leaves memory, when its key has passed."""

    def results(trie):
        for refs, sha, members, best in trie.owners():
            for ref in refs:
                yield ref, sha, best, members

    def run(batches):
        current, trie = None, RadixTrie()
        for rows in batches:
            out = []
            columns = [rows.column(i).to_pylist() for i in range(rows.num_columns)]
            for ref, size, head, body, sha, members, best in zip(*columns):
                if (size, head) != current:
                    out.extend(results(trie))
                    current, trie = (size, head), RadixTrie()
                node = trie.node(body)
                if node.owner is None:
                    node.owner = [{}, sha, 0, None]
                owner = node.owner
                owner[0][ref] = None  # one row for each block that holds the text
                owner[2] += members
                owner[3] = _better(owner[3], best, largest)
            if out:
                yield batch(RESULTS, *zip(*out))
        if out := list(results(trie)):
            yield batch(RESULTS, *zip(*out))

    return run


def groups(frame, id="doc_id", text="text", keep="largest"):
    """The group of each row with equal texts, and which row of it stays.

    Texts are equal when their bytes are, after lower-casing A-Z. Returns one
    row per row of the frame: the identifier, keep_id, group_size, kept and
    text_sha256. A null text is empty; empty texts are one group. `keep` is
    `largest` or `smallest` identifier; a row without identifier stays only if
    no row of its group has one. Rows that repeat text and identifier are kept
    or dropped together. Other columns are not read. An empty table gives none.

    Each block of documents is one set of tries, so that a text leaves a block
    once however often it occurs there. The owners are partitioned by length
    and content hash and inserted, in that order, into tries of full byte
    strings; a finished subtree is emitted and dropped. The result returns to
    the block's members, not to one hot group.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep must be largest or smallest, not {keep}")
    largest = keep == "largest"
    rows = id_and_text(frame, id, text).select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    owners = rows.mapInArrow(_owners(largest), OWNERS)
    results = owners.repartition("bytes", "head").sortWithinPartitions("bytes", "head").mapInArrow(_merge(largest), RESULTS)
    members = rows.mapInArrow(_members(largest), MEMBERS)
    joined = members.alias("m").join(results.alias("r"), F.col("m.ref").eqNullSafe(F.col("r.ref")) & (F.col("m.sha") == F.col("r.sha")))
    return joined.select(
        F.col("id").alias(id),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("m.sha").alias("text_sha256"),
    )


def dedup(frame, id="doc_id", text="text", keep="largest"):
    """The rows that stay, with all their columns.

    A row goes only if its own text was judged a copy: another text under the
    same identifier, or under none, is not touched by that.
    """
    dropped = groups(frame, id, text, keep).filter(~F.col("kept")).select(F.col(id).alias("_gone_id"), F.col("text_sha256").alias("_gone_sha"))
    body = F.coalesce(frame[text].cast("string"), F.lit(""))
    sha = F.sha2(F.translate(body, ascii_uppercase, ascii_lowercase).cast("binary"), 256)
    return frame.join(dropped, frame[id].eqNullSafe(dropped["_gone_id"]) & (sha == dropped["_gone_sha"]), "left_anti")
