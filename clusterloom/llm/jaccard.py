"""N-gram Jaccard join by signature trees, as connected components.

Documents with equal shingle sets are one class. Two classes can only be
similar enough if they share one of the first tokens of their sets in any
order that all sets use; the order is that of the hashes, with tokens that
many documents hold put last. Classes that share such a token form a block.

A first round links the classes of a block to a few leaders, which joins
large groups of near copies by a few links per member. In a second round the
classes of a block, where they still belong to different components, are
leaves of a signature tree: nodes hold the OR of the token bitmaps below
them and the range of set sizes. A dual traversal skips pairs of nodes whose
largest possible overlap is too small, and pairs within one component. What
remains is checked on the whole shingle sets, of every two components the
likeliest pairs first: one link spares the others, and only where none is
found, more of them are looked at, up to the last.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clusterloom.llm.batches import (
    WordHashes,
    let_through,
    marked_slots,
    row_key,
    shingle_hashes,
    slices,
    slot_filter,
    slot_of,
    text_frame,
    texts_of,
    without_rows,
)
from clusterloom.llm.decontaminate import Lookup
from clusterloom.llm.graph import components
from clusterloom.storage import snapshot, work_dir

#: A token in more documents than this goes last in the order, if it is among the most frequent ones.
#: Any choice gives the same links; it only keeps blocks small.
HOT_DOCUMENTS = 32
HOT_TOKENS = 1 << 18

LEADERS = 3

#: Blocks with more classes are split into pairs of parts.
BLOCK_CLASSES = 20_000

#: Blocks with the same lowest component go to so many tasks.
LANES = 4

LEAF, FAN = 16, 8

#: Pairs of two components that a block gives at first, and how many times more in each further round.
FIRST_PAIRS, MORE_PAIRS = 4, 256


@dataclass(frozen=True)
class Rule:
    """Sets of ``words``-word shingles are linked when 100 * intersection >= ``percent`` * union."""

    words: int = 3
    percent: int = 90

    def prefix(self, n: int) -> int:
        """So many first tokens hold one of any partner's first tokens."""
        return n + (-self.percent * n // 100) + 1

    def linked(self, common: int, n_a: int, n_b: int) -> bool:
        return 100 * common >= self.percent * (n_a + n_b - common)

    def needed(self, total: int) -> int:
        """The smallest intersection that links sets of together ``total`` tokens."""
        return -(-self.percent * total // (100 + self.percent))

    def sizes_fit(self, a: Column, b: Column) -> Column:
        return F.least(a, b) * 100 >= F.greatest(a, b) * self.percent


def shingle_set(data: bytes, hashes: WordHashes, words: int) -> np.ndarray:
    """Distinct shingle hashes in order."""
    return np.unique(shingle_hashes(hashes.of(data.lower().split()), words))


def class_of(tokens: np.ndarray) -> int:
    """A 64-bit name of a set; it is used together with the size."""
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def bitmap(tokens: np.ndarray) -> bytes:
    """Each token sets a bit; the width is a power of two, two bits a token at least."""
    width = 1 << max(6, (2 * len(tokens) - 1).bit_length())
    bits = np.zeros(width, bool)
    bits[(tokens & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def first_tokens(own: np.ndarray, size: int, hot: Lookup | None) -> np.ndarray:
    """The first tokens of a set in the common order: by hash, hot ones last."""
    first = own[:size]
    if hot is not None and len(hot.places(first)[0]):
        late = hot.places(own)[0]
        first = np.concatenate([np.delete(own, late), own[late]])[:size]
    return first.view(np.int64)


def sets_in_batches(rule: Rule, held=None, wanted=None):
    """Class, size, bitmap and first tokens of every text, or of those that a filter lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, hot = WordHashes(), Lookup(held.value) if held is not None else None
        for batch in slices(batches):
            if wanted is not None:
                batch = batch.filter(marked_slots(batch["slot"], wanted.value))
            sets = [shingle_set(data, hashes, rule.words) for data in texts_of(batch["text"])]
            first = [first_tokens(own, rule.prefix(len(own)) if len(own) else 0, hot) for own in sets]
            names = [name for name in ("id", "row") if name in batch.schema.names]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch[name] for name in names],
                    pa.array([class_of(own) for own in sets], pa.int64()),
                    pa.array([len(own) for own in sets], pa.int64()),
                    pa.array([bitmap(own) if len(own) else None for own in sets], pa.binary()),
                    pa.array(first, pa.list_(pa.int64())),
                ],
                [*names, "class", "n", "bitmap", "tokens"],
            )

    return run


def text_sets(rows: DataFrame, rule: Rule, held=None, wanted=None) -> DataFrame:
    kind = rows.schema["id"].dataType.simpleString()
    kinds = f"id {kind}, row long" if "row" in rows.columns else f"id {kind}"
    if wanted is not None:
        rows = rows.withColumn("slot", slot_of("id"))
    return rows.mapInArrow(
        sets_in_batches(rule, held, wanted), f"{kinds}, class long, n long, bitmap binary, tokens array<long>"
    )


class Node:
    """Classes below a node: the OR of their bitmaps, their sizes, and what bitmaps may hide.

    A leaf has one class, as (name, part), and no children. A node over
    bitmaps of several widths has none itself, its width is 0.
    """

    __slots__ = ("bits", "children", "high", "leaf", "low", "owner", "slack", "width")

    def __init__(self, bits: int, width: int, low: int, high: int, slack: int, owner, leaf=None, children=()):
        self.bits, self.width, self.low, self.high, self.slack = bits, width, low, high, slack
        self.owner, self.leaf, self.children = owner, leaf, children


def folded(bits: int, width: int, to: int) -> int:
    """A bitmap at a smaller width."""
    while width > to:
        width //= 2
        bits = (bits | bits >> width) & ((1 << width) - 1)
    return bits


def leaf(name: int, n: int, component: int | None, part: int, data: bytes) -> Node:
    bits = int.from_bytes(data, "little")
    # Bits that several tokens share hide so many of them from a count of bits.
    return Node(bits, 8 * len(data), n, n, n - bits.bit_count(), component, leaf=(name, part))


def parent(children: list[Node]) -> Node:
    widths, owners = {child.width for child in children}, {child.owner for child in children}
    bits = 0
    if len(widths) == 1:
        for child in children:
            bits |= child.bits
    return Node(
        bits,
        widths.pop() if len(widths) == 1 else 0,
        min(child.low for child in children),
        max(child.high for child in children),
        max(child.slack for child in children),
        owners.pop() if len(owners) == 1 else None,
        children=children,
    )


def grown(leaves: list[Node]) -> Node:
    """A tree in which members of a component, and classes of like size, are near each other."""
    smallest: dict = {}
    for node in leaves:
        smallest[node.owner] = min(node.low, smallest.get(node.owner, node.low))
    level, fan = sorted(leaves, key=lambda node: (smallest[node.owner], node.owner, node.low)), LEAF
    while len(level) > 1:
        level = [parent(level[at : at + fan]) for at in range(0, len(level), fan)]
        fan = FAN
    return level[0]


def may_link(a: Node, b: Node, rule: Rule) -> bool:
    """Can the largest overlap of classes below two nodes link any of them?"""
    if a.owner is not None and a.owner == b.owner:
        return False
    if 100 * a.high < rule.percent * b.low or 100 * b.high < rule.percent * a.low:
        return False
    bits_a, bits_b, slack_a, slack_b = a.bits, b.bits, a.slack, b.slack
    if a.width != b.width:
        if a.leaf is None or b.leaf is None:
            return True
        width = min(a.width, b.width)
        bits_a, bits_b = folded(bits_a, a.width, width), folded(bits_b, b.width, width)
        slack_a, slack_b = a.low - bits_a.bit_count(), b.low - bits_b.bit_count()
    elif a.width == 0:
        return True
    largest = min((bits_a & bits_b).bit_count() + min(slack_a, slack_b), a.high, b.high)
    return largest >= rule.needed(a.low + b.low)


def tree_pairs(root: Node, rule: Rule, crossing: bool) -> Iterator[tuple[Node, Node]]:
    """Leaves whose classes may be linked, by dual traversal; ``crossing`` asks for different parts."""
    todo = [(root, root)]
    while todo:
        a, b = todo.pop()
        if a is b:
            if a.owner is None:
                for i, child in enumerate(a.children):
                    todo.append((child, child))
                    todo += [(child, other) for other in a.children[i + 1 :]]
        elif not may_link(a, b, rule):
            continue
        elif a.leaf and b.leaf:
            if a.leaf[0] != b.leaf[0] and not (crossing and a.leaf[1] == b.leaf[1]):
                yield a, b
        elif a.leaf or (not b.leaf and b.high - b.low > a.high - a.low):
            todo += [(a, child) for child in b.children]
        else:
            todo += [(child, b) for child in a.children]


def likeness(a: Node, b: Node) -> float:
    """How alike the bitmaps of two leaves are."""
    width = min(a.width, b.width)
    bits_a, bits_b = folded(a.bits, a.width, width), folded(b.bits, b.width, width)
    return (bits_a & bits_b).bit_count() / (bits_a | bits_b).bit_count()


def likeliest(
    pairs: Iterator[tuple[Node, Node]], most: int, before: int = 0
) -> Iterator[tuple[int, int, bool]]:
    """Of the pairs between two components those most alike, and whether there are more.

    One link joins two components, and then their other pairs need no look.
    Where no more than ``before`` pairs are found, an earlier round that gave
    so many gave them all, since components only grow.
    """
    found: dict[tuple[int, int], tuple[list, int]] = {}
    for a, b in pairs:
        key = (min(a.owner, b.owner), max(a.owner, b.owner))
        names = sorted((a.leaf[0], b.leaf[0]))
        heap, seen = found.get(key, ([], 0))
        if len(heap) < most:
            heapq.heappush(heap, (likeness(a, b), *names))
        else:
            heapq.heappushpop(heap, (likeness(a, b), *names))
        found[key] = (heap, seen + 1)
    for heap, seen in found.values():
        if seen > before:
            for _, a, b in heap:
                yield a, b, seen > most


def block_pairs_in_batches(rule: Rule, most: int, before: int):
    """Candidate pairs of blocks that come one after another, sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, leaves, pairs = None, [], {}

        def closed() -> None:
            if len(leaves) > 1:
                for a, b, more in likeliest(tree_pairs(grown(leaves), rule, key[1] != key[2]), most, before):
                    pairs[a, b] = pairs.get((a, b), False) or more

        def out() -> pa.RecordBatch:
            columns = [*zip(*pairs), list(pairs.values())]
            kinds = (pa.int64(), pa.int64(), pa.bool_())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["a", "b", "more"])

        names = ("token", "i", "j", "class", "n", "component", "part", "bitmap")
        for batch in slices(batches, 4096):
            for token, i, j, name, n, component, part, data in zip(*(batch[x].to_pylist() for x in names)):
                if key != (token, i, j):
                    closed()
                    key, leaves = (token, i, j), []
                leaves.append(leaf(name, n, component, part, data))
            if len(pairs) > 100_000:
                yield out()
                pairs.clear()
        closed()
        if pairs:
            yield out()

    return run


def verified_in_batches(rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, last, kept = WordHashes(), None, None
        for batch in slices(batches):
            a, b = [], []
            rows = zip(batch["a"].to_pylist(), batch["b"].to_pylist(), texts_of(batch["text_a"]), texts_of(batch["text_b"]))
            for name_a, name_b, text_a, text_b in rows:
                if name_a != last:
                    last, kept = name_a, shingle_set(text_a, hashes, rule.words)
                other = shingle_set(text_b, hashes, rule.words)
                if rule.linked(len(np.intersect1d(kept, other, assume_unique=True)), len(kept), len(other)):
                    a.append(name_a)
                    b.append(name_b)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def texts_in_batches(rule: Rule, wanted):
    """Class and text of the documents that a filter lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches):
            batch = batch.filter(marked_slots(batch["slot"], wanted.value))
            names = [class_of(shingle_set(data, hashes, rule.words)) for data in texts_of(batch["text"])]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), batch["text"]], ["class", "text"])

    return run


def verified(pairs: DataFrame, classes: DataFrame, rows: DataFrame, rule: Rule) -> DataFrame:
    """Those of the candidate pairs (a, b) whose shingle sets are similar enough.

    Documents come into play only where a pair asks for their class: a filter
    of fixed size drops most others before the shuffle.
    """
    asked = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct()
    held = slot_filter(classes.join(asked, "class"), "first_id")
    texts = rows.select("text", slot_of("id").alias("slot")).mapInArrow(
        texts_in_batches(rule, held), "class long, text string"
    )
    texts = snapshot(texts.join(asked, "class", "left_semi").dropDuplicates(["class"]), work_dir(rows.sparkSession))
    with_b = pairs.join(texts.select(F.col("class").alias("b"), F.col("text").alias("text_b")), "b")
    with_both = with_b.join(texts.select(F.col("class").alias("a"), F.col("text").alias("text_a")), "a")
    found = with_both.sortWithinPartitions("a").mapInArrow(verified_in_batches(rule), "a long, b long")
    return snapshot(found, work_dir(rows.sparkSession))


def star_edges(blocks: DataFrame, rule: Rule) -> DataFrame:
    """Pairs of each class with a few leaders of its blocks, of fitting sizes."""
    sized = blocks.withColumn("size_class", F.floor(F.log("n") / math.log(100 / rule.percent)))
    places = [F.struct(F.xxhash64("class", F.lit(number)), "class", "n") for number in range(LEADERS)]
    leaders = sized.groupBy("token", "size_class").agg(
        F.array(*[F.struct(F.min(place)["class"].alias("class"), F.min(place)["n"].alias("n")) for place in places]).alias("leaders")
    )
    found = sized.join(leaders, ["token", "size_class"]).select("class", "n", F.explode("leaders").alias("leader"))
    found = found.filter((F.col("class") != F.col("leader.class")) & rule.sizes_fit(F.col("n"), F.col("leader.n")))
    return found.select(
        F.least("class", "leader.class").alias("a"), F.greatest("class", "leader.class").alias("b")
    ).distinct()


def with_bitmaps(pairs: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """Pairs that the bound by bitmaps does not rule out."""

    def side(name: str) -> DataFrame:
        return classes.select(F.col("class").alias(name), F.col("n").alias(f"n_{name}"), F.col("bitmap").alias(f"m_{name}"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            columns = [batch[name].to_pylist() for name in ("a", "n_a", "m_a", "b", "n_b", "m_b")]
            mask = [
                may_link(leaf(a, n_a, None, 0, m_a), leaf(b, n_b, None, 0, m_b), rule)
                for a, n_a, m_a, b, n_b, m_b in zip(*columns)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(mask, pa.bool_()))

    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "n_a", "m_a", "b", "n_b", "m_b")
    return joined.mapInArrow(keep, "a long, b long")


def of_fitting_size(blocks: DataFrame, rule: Rule) -> DataFrame:
    """Members of blocks that another member fits in size; the nearest in size fits if any does."""
    by_size = Window.partitionBy("token").orderBy("n", "class")
    before, after = F.lag("n").over(by_size), F.lead("n").over(by_size)
    near = blocks.withColumn("before", before).withColumn("after", after)
    fits_before = F.col("before") * 100 >= F.col("n") * rule.percent
    fits_after = F.col("n") * 100 >= F.col("after") * rule.percent
    return near.filter(F.coalesce(fits_before, F.lit(False)) | F.coalesce(fits_after, F.lit(False))).drop("before", "after")


def shared_prefixes(rows: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """Blocks: columns token, class and n of the classes that share a first token with one of fitting size."""
    spark = rows.sparkSession
    exploded = classes.select("first_id", "class", "n", F.explode("tokens").alias("token"))
    counted = exploded.groupBy("token").agg(F.count(F.lit(1)).alias("documents"))
    hot = counted.filter(F.col("documents") > HOT_DOCUMENTS).orderBy(F.desc("documents"), "token").limit(HOT_TOKENS)
    hot = snapshot(hot.select("token"), work_dir(spark))
    tokens = np.sort(hot.toArrow()["token"].to_numpy().astype(np.int64).view(np.uint64))
    # Only sets with a hot token among the first ones have others first once these go last.
    changed = exploded.join(F.broadcast(hot), "token", "left_semi")
    held = slot_filter(changed, "first_id")
    anew = text_sets(rows, rule, spark.sparkContext.broadcast(tokens), held)
    known = classes.filter(~let_through(slot_of("first_id"), held))
    first = known.select("class", "n", "tokens").unionByName(anew.select("class", "n", "tokens"))
    placed = first.select("class", "n", F.explode("tokens").alias("token"))
    block = Window.partitionBy("token")
    shared = placed.select("*", F.min("class").over(block).alias("low"), F.max("class").over(block).alias("high"))
    return of_fitting_size(shared.filter("low <> high").select("token", "class", "n").distinct(), rule)


def block_pairs(
    blocks: DataFrame, classes: DataFrame, owners: DataFrame, rule: Rule, most: int, before: int
) -> DataFrame:
    """Candidate pairs between components, from the signature trees of all blocks that hold several.

    Of every two components a block gives at most ``most`` pairs; ``more``
    tells that it has others. An earlier round has given up to ``before``.
    """
    spark = blocks.sparkSession
    owned = blocks.join(owners, "class", "left").withColumn("component", F.coalesce("component", "class"))
    block = Window.partitionBy("token")
    mixed = owned.select(
        "*",
        F.min("component").over(block).alias("low"),
        F.max("component").over(block).alias("high"),
        F.count(F.lit(1)).over(block).alias("members"),
    ).filter("low <> high")
    parts = F.ceil(F.col("members") / F.lit(BLOCK_CLASSES)).cast("int")
    tiled = (
        mixed.withColumn("parts", parts)
        .withColumn("part", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("i", F.least("part", "other"))
        .withColumn("j", F.greatest("part", "other"))
        .withColumn("lane", F.pmod("token", F.lit(LANES)))
    )
    marked = tiled.join(classes.select("class", "bitmap"), "class")
    # Blocks of one neighbourhood meet in a few tasks, where the pairs they have in common become one.
    ordered = marked.repartition("low", "lane", "i", "j").sortWithinPartitions("token", "i", "j")
    pairs = ordered.select("token", "i", "j", "class", "n", "component", "part", "bitmap").mapInArrow(
        block_pairs_in_batches(rule, most, before), "a long, b long, more boolean"
    )
    return snapshot(pairs.groupBy("a", "b").agg(F.bool_or("more").alias("more")), work_dir(spark))


def owners_of(links: DataFrame) -> DataFrame:
    return components(links).select(F.col("node").alias("class"), "component")


def remaining_blocks(blocks: DataFrame, pairs: DataFrame, owners: DataFrame) -> DataFrame:
    """Members of blocks whose component belongs to a pair that had more than were looked at."""
    asked = pairs.filter("more").select(F.explode(F.array("a", "b")).alias("class")).distinct()
    asked = asked.join(owners, "class", "left").select(F.coalesce("component", "class").alias("component")).distinct()
    owned = blocks.join(owners, "class", "left").withColumn("component", F.coalesce("component", "class"))
    return snapshot(owned.join(asked, "component", "left_semi").select(blocks.columns), work_dir(blocks.sparkSession))


def all_links(blocks: DataFrame, classes: DataFrame, rows: DataFrame, rule: Rule) -> DataFrame:
    """Owners of all classes that are linked with another, so that no two linked ones differ in their owner.

    Stars first; then, as long as some pair of components has pairs of
    classes that were not looked at, the likeliest of them, ever more.
    """
    spark = rows.sparkSession
    stars = snapshot(with_bitmaps(star_edges(blocks, rule), classes, rule), work_dir(spark))
    links = verified(stars, classes, rows, rule)
    owners, looked_at, most = snapshot(owners_of(links), work_dir(spark)), stars.select("a", "b"), FIRST_PAIRS
    before = 0
    while True:
        pairs = block_pairs(blocks, classes, owners, rule, most, before)
        fresh = pairs.select("a", "b").join(looked_at, ["a", "b"], "left_anti")
        found = verified(snapshot(fresh, work_dir(spark)), classes, rows, rule)
        if not found.isEmpty():
            links = links.unionByName(found)
            owners = snapshot(owners_of(links), work_dir(spark))
        if pairs.filter("more").isEmpty():
            return owners
        blocks = remaining_blocks(blocks, pairs, owners)
        looked_at, before, most = looked_at.unionByName(pairs.select("a", "b")), most, most * MORE_PAIRS


def similar_documents(
    df: DataFrame, rule: Rule = Rule(), id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Size of the shingle set and component of every document: id, n_shingles, component_id.

    Words are runs without ASCII white space, A-Z in lower case. A text with
    fewer words than a shingle is one shingle; one without words, or missing,
    has none and is linked with nothing. The component is the smallest id
    reachable by links, the document's own included. Documents with equal
    sets always share one; rows that share an id are judged each. Other
    columns are ignored. Links are exact up to equal 64-bit hashes of
    different shingles.
    """
    found = with_components(text_frame(df, id_column, text_column), rule)
    return found.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), "component_id")


def with_components(rows: DataFrame, rule: Rule) -> DataFrame:
    """Columns id, n and component_id, and row where there is one, from columns id, text and maybe row."""
    folder = work_dir(rows.sparkSession)
    names = [name for name in rows.columns if name != "text"]
    members = snapshot(text_sets(rows, rule), f"{folder}/members")
    rows = rows.select("id", "text")
    same = F.first(F.struct("bitmap", "tokens")).alias("same")
    classes = members.filter("n > 0").groupBy("class", "n").agg(F.min("id").alias("first_id"), same)
    classes = snapshot(classes.select("class", "n", "first_id", "same.*"), f"{folder}/classes")
    blocks = snapshot(shared_prefixes(rows, classes, rule), f"{folder}/blocks")
    owners = all_links(blocks, classes, rows, rule)
    named = classes.select("class", "n", "first_id").join(owners, "class", "left")
    named = named.withColumn("component", F.coalesce("component", "class"))
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    placed = named.join(smallest, "component").select(F.col("class").alias("of"), F.col("n").alias("of_n"), "component_id")
    found = members.select(*names, "class", "n").join(
        placed, (F.col("class") == F.col("of")) & (F.col("n") == F.col("of_n")), "left"
    )
    return found.select(*names, "n", F.coalesce("component_id", "id").alias("component_id"))


def one_of_each(df: DataFrame, rule: Rule, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of one document of each component, that with the smallest id; all rows that share this id stay.

    Rows go one by one: of rows without an id only those go that are copies of
    a document with one, and of rows that share an id only those whose own
    component has a smaller one.
    """
    found = with_components(text_frame(df, id_column, text_column, row_key(id_column, text_column).alias("row")), rule)
    dropped = found.filter(~F.col("id").eqNullSafe(F.col("component_id")))
    dropped = snapshot(dropped.select(F.col("row").alias("dropped_row")).distinct(), work_dir(df.sparkSession))
    return without_rows(df, id_column, text_column, dropped)
