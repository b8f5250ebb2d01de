"""Spelling variants: words that differ by one code point, found by walking a trie as a relation.

The distinct words form a trie whose nodes are their beginnings; its edges are
a distributed table (parent, letter, child). States (word, position, node,
edits) walk it level by level, each level one join of the frontier with the
edge table:

* with no edit made, a word stands on its own path, which needs no join: the
  state at position i is the node of its first i letters. From each such node
  it may read a wrong letter, skip one of its own or take one more from the
  trie, and becomes a state with one edit;
* with one edit made, the next letter must have an edge.

A state that ends at a word's node with one edit names a neighbour.

**Two tries.** Two words one edit apart agree on the first half of the one or
on the rest of it. So words walk twice: in the trie of words with edits from
the middle on, and in the trie of reversed words with edits in the other half.
No state starts at the root or the few nodes below it, where all words would
meet in a handful of join keys and every letter has an edge.

**Long words.** Levels are as many as ``WALK`` letters allow. Words of
``WALK`` letters or more find each other through the hashes of what remains
after one deletion, confirmed on the words; a pair of which either is longer
than ``WALK`` consists of such words, so the two ways cover every pair.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, text_batches

#: Words of up to so many code points walk the trie.
WALK = 48

LETTERS = "A-Za-zÀ-ÿ"


def count_runs(found: Counter, text: str | None, doc_id: str | None, every: int = 97, shortest: int = 5) -> None:
    """Add the runs of a text after the deletions to ``found``; A-Z are lower-cased. Shorter runs can't become words."""
    # bytes.lower() folds A-Z alone
    lowered = (text or "").encode("utf-8", "replace").lower().decode("utf-8")
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(re.findall(f"[{LETTERS}]{{{shortest},}}", lowered)).items():
        h = zlib.crc32(run.encode(), start)
        if not h % every:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        found[run] += n


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text: str = "text", every: int = 97, shortest: int = 5,
               least: int = 3) -> DataFrame:
    """(word, n): the distinct words of at least ``shortest`` code points that occur ``least`` times or more."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            found: Counter = Counter()
            for doc_id, t in zip(frame["id"], frame["t"]):
                count_runs(found, t, doc_id, every, shortest)
            words = [w for w in found if len(w) >= shortest]
            yield pd.DataFrame({"word": pd.Series(words, dtype=object), "n": pd.Series([found[w] for w in words], dtype="int64")})
    # ids as text: a column of longs with NULLs would reach pandas as floats
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text).alias("t"))
    return text_batches(rows).mapInPandas(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def edge_table(words: DataFrame) -> DataFrame:
    """(node, letter, child, ends, further) of the trie of ``words`` (one column ``word``, distinct).

    A node is named by the beginning that leads to it. ``ends`` is true where
    the child is a word; ``further`` holds the letters that go on from the child.
    """
    steps = words.select("word", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("at"))
    child, after = F.expr("substring(word, 1, at)"), F.expr("substring(word, at + 1, 1)")
    return (steps.groupBy(child.alias("child")).agg(F.max(F.col("at") == F.length("word")).alias("ends"),
                                                    F.array_join(F.collect_set(after), "").alias("further"))
            .select(F.expr("substring(child, 1, length(child) - 1)").alias("node"), F.expr("right(child, 1)").alias("letter"),
                    "child", "ends", "further"))


def _alive(states: DataFrame) -> DataFrame:
    """The states (word, at, child, ends, further) that end at a word or have an edge to go on by."""
    whole = F.length("word")
    return states.filter(((F.col("at") == whole) & F.col("ends"))
                         | ((F.col("at") < whole) & (F.expr("instr(further, substring(word, at + 1, 1))") > 0)))


def walk(words: DataFrame, begin, name: str) -> DataFrame:
    """(word, near) of all pairs that differ by one edit at position ``begin`` (a column of ``word``) or later.

    A pair may be found more than once and from either side.
    """
    edges = stored(edge_table(words), f"{name}-edges")
    longest = words.agg(F.max(F.length("word"))).first()[0]
    if longest is None:
        return words.select("word", F.col("word").alias("near"))
    # the first edit is made at any node of the word's own path from ``begin`` on: an edge may be read in place of the word's
    # next letter, before it, or as the letter behind it
    path = words.select("word", F.explode(F.sequence(begin, F.length("word"))).alias("at")) \
        .withColumn("from", F.expr("substring(word, 1, at)"))
    edits = F.expr("""filter(array(IF(at < length(word) AND letter <> substring(word, at + 1, 1), at + 1, -1), at,
                                   IF(letter = substring(word, at + 2, 1), at + 2, -1)), x -> x >= 0)""")
    made = path.join(edges, F.col("from") == F.col("node")).select("word", "child", "ends", "further", F.explode(edits).alias("at"))
    frontier = stored(_alive(made), f"{name}-level")
    # the last letter skipped: the path's last node but one is itself a word
    cut = words.select("word", F.expr("substring(word, 1, length(word) - 1)").alias("near"))
    found = cut.join(words.select(F.col("word").alias("w")), F.col("near") == F.col("w")).select("word", "near")
    for _ in range(longest + 1):
        found = found.unionByName(frontier.filter((F.col("at") == F.length("word")) & F.col("ends")).select("word", F.col("child").alias("near")))
        going = frontier.filter(F.col("at") < F.length("word")).select(
            "word", "at", F.col("child").alias("from"), F.expr("substring(word, at + 1, 1)").alias("own"))
        frontier = stored(_alive(going.join(edges, (F.col("from") == F.col("node")) & (F.col("own") == F.col("letter")))
                                 .select("word", "child", "ends", "further", (F.col("at") + 1).alias("at"))), f"{name}-level")
        if frontier.isEmpty():
            break
    return found.filter("word <> near")


def one_edit(a: str, b: str) -> bool:
    """Whether the words differ by exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + (len(a) == len(b)):] == b[at + 1:]


def _long_pairs(words: DataFrame) -> DataFrame:
    """(word, near) of words that share what remains after a deletion, or of which one remains of the other."""
    @F.udf("array<long>")
    def remains(word):
        # a polynomial hash of the word without each letter, and of the word itself
        base, mod = 1_000_003, (1 << 61) - 1
        heads, power = [0], [1]
        for c in word:
            heads.append((heads[-1] * base + ord(c) + 1) % mod)
            power.append(power[-1] * base % mod)
        whole, m = heads[-1], len(word)
        return list({whole, *((heads[i] * power[m - 1 - i] + whole - heads[i + 1] * power[m - 1 - i]) % mod for i in range(m))})

    @F.udf("boolean")
    def near(a, b):
        return one_edit(a, b)

    # only hashes and a short name of each word are exchanged before pairs meet
    named = stored(words.withColumn("name", F.xxhash64("word")).withColumn("keys", remains("word")), "spelling-long")
    keys = named.select("name", F.explode("keys").alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("many")).filter("many > 1").select("key")
    members = stored(keys.join(shared, "key"), "spelling-long-keys")
    pairs = (members.join(members.select("key", F.col("name").alias("other")), "key").filter("name < other")
             .select("name", "other").distinct())
    a = named.select("name", "word")
    b = named.select(F.col("name").alias("other"), F.col("word").alias("near"))
    return pairs.join(a, "name").join(b, "other").filter(near("word", "near")).select("word", "near")


def neighbours(words: DataFrame, walk_to: int = WALK) -> DataFrame:
    """Every (word, near), both ways and once, of distinct ``words`` that are one edit apart."""
    short = words.filter(F.length("word") <= walk_to).select("word")
    half = F.expr("length(word) DIV 2")
    forward = walk(short, half, "spelling-ahead")
    turned = walk(stored(short.select(F.reverse("word").alias("word")), "spelling-turned"), F.length("word") - half, "spelling-back")
    pairs = forward.unionByName(turned.select(F.reverse("word").alias("word"), F.reverse("near").alias("near")))
    long = words.filter(F.length("word") >= walk_to).select("word")
    if not long.isEmpty():
        pairs = pairs.unionByName(_long_pairs(long))
    ways = F.explode(F.array(F.struct("word", "near"), F.struct(F.col("near").alias("word"), F.col("word").alias("near"))))
    return pairs.select(ways.alias("p")).select("p.word", "p.near").distinct()


def group(docs: DataFrame, id_col: str = "doc_id", text: str = "text", every: int = 97, shortest: int = 5, least: int = 3,
          times: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary.

    ``form`` is the near word that occurs most often (ties: the smallest in
    code-point order) if it occurs at least ``times`` times as often as the
    word; ``root`` is the last of the forms that follow from the word. NULL
    and empty texts have no words; a NULL id counts as the empty id;
    repeated rows count each. Extra columns are not read; an empty table gives an empty one.
    """
    words = stored(vocabulary(docs, id_col, text, every, shortest, least), "spelling-words")
    near = stored(neighbours(words), "spelling-near")
    counts = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    # the largest n, then the smallest word: a minimum of (-n, word)
    best = (near.join(counts, "near").groupBy(F.col("word").alias("of"))
            .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("b")))
    linked = words.join(best, F.col("word") == F.col("of"), "left")
    is_form = -F.col("b.minus") >= times * F.col("n")
    rows = stored(linked.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("b.near")).alias("form"),
                                F.when(is_form, -F.col("b.minus")).alias("form_n")), "spelling-forms")
    # forms grow by a factor each, so paths are short; each round doubles what a pointer spans
    jump = stored(rows.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = jump.select(F.col("word").alias("of"), F.col("root").alias("next"))
        now = stored(jump.join(further, F.col("root") == F.col("of"), "left")
                     .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        jump = now.select("word", "root")
        if now.filter("moved").isEmpty():
            break
    roots = jump.select(F.col("word").alias("of"), F.col("root"))
    return (rows.join(roots, F.col("word") == F.col("of"), "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
