"""Toxicity of deobfuscated text.

Obfuscation is taken as a noisy channel: letters come out as look-alikes, are
repeated, or are set apart.  Every suspicious piece of text becomes a lattice of
what its characters may stand for, and the Viterbi path under a character
language model of the whole corpus restores it.  A logistic regression over
words and word beginnings scores the restored text.
"""

from __future__ import annotations

import math
import re
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.worker import remembered, small_batches
from tidemark.session import cut_lineage

#: Symbols of the language model: a word's edge, a-z, the accented letters of Latin-1, any other letter.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
EDGE, OTHER, SYMBOLS = 0, len(LETTERS) + 1, 64
SYMBOL = {letter: i + 1 for i, letter in enumerate(LETTERS)}
#: What a character may stand for besides itself (fixed values: common look-alikes).
LOOKS = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g", "2": "z",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "<": "c", "¡": "i", "§": "s",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "т": "t", "м": "m",
    "н": "h", "к": "k", "в": "b", "α": "a", "ε": "e", "ι": "i", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "ν": "v",
}
#: Any letter may be hidden behind one of these, between two letters.
HIDING = "*#%"
#: Costs of the channel in nats: a look-alike, a character as a gap between words, one left out, a repetition undone.
LOOK_ALIKE, GAP, LEFT_OUT, HIDDEN, UNDOUBLED, UNREPEATED = 0.7, 10.0, 1.5, 0.5, 5.0, 0.7
#: A gap between two words, next to a letter that stands alone and elsewhere.
LONE_GAP, WORD_GAP = 4.0, 1.0
#: Three groups or more, set apart by any white space: of one character each, and of up to three.
SPACED, SPLIT = (
    re.compile(rf"(?<![^\s\"'(\[{{«]){group}(?:\s+{group}){{2,}}(?=[.,;:?!\"')\]}}…»]*(?!\S))")
    for group in (r"[^\s.,;:]", r"[^\s.,;:]{1,3}")
)
WORDS = re.compile(r"[^\W\d_]+")
REPEATED = re.compile(r"(.)\1")
RUN = re.compile(r"(.)\1*", re.S)
TRIPLE = re.compile(r"(.)\1\1")
#: A word of plain Latin letters, with marks behind it that stand for no letter.
LATIN = re.compile("([a-zß-öø-ÿ]+)[.,;:]*")
#: Groups of plain Latin letters.
LATIN_GROUPS = re.compile("[a-zß-öø-ÿ ]+")
#: Pieces of text remembered per Python worker, none longer than this; beyond it the memory is emptied.
REMEMBERED, LONGEST = 200_000, 64
#: The same while features are made, where every word of a piece is kept.
HELD = 40_000
#: Groups read again from each group on.
AHEAD = 24
#: Lengths of word beginnings used as features.
BEGINNINGS = (4, 5, 6)
#: A stem is dense if it is one in so many different pieces of a text.
DENSITIES = (256, 64)


class Model(NamedTuple):
    """Character language model (log probabilities by symbol triple) and word weights."""

    language: np.ndarray
    weights: dict[str, float]
    intercept: float


def symbol_table() -> np.ndarray:
    """Symbol of every code point, after lower-casing."""
    table = np.zeros(0x110000, np.uint8)
    for code in range(0x250, 0x30000):
        if chr(code).isalpha():
            table[code] = OTHER
    for code in range(0x250):
        if chr(code).isalpha():
            table[code] = SYMBOL.get(chr(code).lower(), OTHER)
    return table


def portions(texts: pd.Series, size: int) -> Iterator[list[str]]:
    """Texts in groups of about ``size`` characters, so that what is made of them stays small."""
    held: list[str] = []
    total = 0
    for body in texts:
        held.append(body)
        total += len(body)
        if total >= size:
            yield held
            held, total = [], 0
    if held:
        yield held


def language_counts(docs: DataFrame, text: str) -> DataFrame:
    """(gram, n): how often each run of three symbols occurs in all texts, word edges included."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = remembered("toxicity symbols", symbol_table)
        total = np.zeros(SYMBOLS**3, np.int64)
        for batch in batches:
            for texts in portions(batch["text"], 1 << 20):
                # A line break between texts: no run crosses documents.
                codes = np.frombuffer("\n".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
                symbols = table[codes]
                # Several characters between two words are one edge.
                symbols = symbols[np.r_[True, (symbols[1:] != EDGE) | (symbols[:-1] != EDGE)]].astype(np.int32)
                runs = (symbols[:-2] * SYMBOLS + symbols[1:-1]) * SYMBOLS + symbols[2:]
                total += np.bincount(runs, minlength=len(total))
        grams = np.flatnonzero(total)
        yield pd.DataFrame({"gram": grams.astype(np.int64), "n": total[grams]})

    texts = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    return texts.mapInPandas(counted, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def language_model(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Log probability of a symbol after two others, smoothed by shorter runs.

    Counted over every document; the table that reaches the driver has at most
    64**3 rows.
    """
    count = np.zeros(SYMBOLS**3)
    for row in language_counts(docs, text).toLocalIterator():
        count[row["gram"]] = row["n"]
    three = count.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    two, one = three.sum(0), three.sum((0, 1))
    p1 = (one + 0.5) / (one.sum() + 0.5 * SYMBOLS)
    p2 = (two + 2 * p1) / (two.sum(1, keepdims=True) + 2)
    p3 = (three + 2 * p2[None]) / (three.sum(2, keepdims=True) + 2)
    return np.log(p3).astype(np.float32)


#: Score and reading (linked backwards) by the last two symbols.
Paths = dict[tuple[int, int], tuple[float, tuple | None]]
START: Paths = {(EDGE, EDGE): (0.0, None)}


class Restorer:
    """Viterbi decoding of suspicious pieces of text."""

    def __init__(self, language: np.ndarray):
        self.language = language.tolist()

    def lattice(self, piece: str, doubled: bool = False) -> list[list[tuple[str, float]]]:
        """For each run of one character what it may stand for, with its cost.

        With ``doubled`` two look-alikes are two letters.
        """
        runs = [m.group() for m in re.finditer(r"(.)\1*", piece, re.S)]
        # Single characters between marks or spaces belong together rather than not.
        lone = re.search(r"(?:^|[\W_])\w(?:[\W_]+\w){2,}(?:$|[\W_])", piece) is not None
        gap = LONE_GAP if lone else WORD_GAP
        steps = []
        for i, run in enumerate(runs):
            char, length = run[0], len(run)
            within = 0 < i < len(runs) - 1 and runs[i - 1][0].isalnum() and runs[i + 1][0].isalnum()
            hiding = char in HIDING and within and not lone
            options: list[tuple[str, float]] = []
            if char.isalpha():
                options.append((run, 0.0))
                if length > 1:
                    options.append((char, UNDOUBLED if length == 2 else UNREPEATED))
                if length > 2:
                    options.append((char * 2, UNREPEATED))
            elif char.isalnum():
                options.append((" ", GAP))
            else:
                # A mark that looks like a letter, before another character, is rather that letter.
                meant = 6.0 * (char in LOOKS and i < len(runs) - 1) + 8.0 * hiding
                options += [(" ", gap + meant), ("", 0.0 if lone else LEFT_OUT + meant)]
            options += looking(run, doubled)
            if hiding:
                options += [(hidden * length, HIDDEN * length) for hidden in "abcdefghijklmnopqrstuvwxyz"]
            steps.append(options)
        return steps

    def step(self, paths: Paths, options: list[tuple[str, float]]) -> Paths:
        """The best path to each pair of last symbols, one run of characters further."""
        reached: Paths = {}
        for (a, b), (score, read) in paths.items():
            for out, cost in options:
                x, y, gained = a, b, score - cost
                for char in out:
                    z = EDGE if char == " " else SYMBOL.get(char, OTHER)
                    if z == EDGE and y == EDGE:
                        continue
                    gained += self.language[x][y][z]
                    x, y = y, z
                known = reached.get((x, y))
                if known is None or gained > known[0]:
                    reached[(x, y)] = (gained, (read, out) if out else read)
        return reached

    def best(self, paths: Paths) -> str:
        """What the likeliest path reads."""
        # A word ends where the piece ends.
        ends = (
            (score + (self.language[a][b][EDGE] if b != EDGE else 0.0), read) for (a, b), (score, read) in paths.items()
        )
        read = max(ends, key=lambda end: end[0])[1]
        parts = []
        while read:
            read, out = read
            parts.append(out)
        return "".join(reversed(parts))

    def __call__(self, piece: str) -> str:
        """The likeliest reading of a piece, words set apart by spaces."""
        paths = START
        for options in self.lattice(piece):
            paths = self.step(paths, options)
        return self.best(paths)

    def through(self, paths: Paths, marks: str, doubled: bool, anew: bool = False) -> Iterator[tuple[Paths, Paths]]:
        """After each run of marks that looks like a letter: the paths that read it, and these with those that leave it out.

        With ``anew`` a word may begin at any of them.
        """
        for run in re.finditer(r"(.)\1*", marks):
            options = looking(run[0], doubled)
            if not options:
                continue
            read = self.step({**paths, **START} if anew else paths, options)
            every = dict(read)
            for state, (score, before) in paths.items():
                if state != (EDGE, EDGE) and (state not in every or score - LEFT_OUT > every[state][0]):
                    every[state] = (score - LEFT_OUT, before)
            yield read, every
            paths = every

    def readings(self, piece: str) -> Iterator[str]:
        """Readings of a piece whose ends may be decoration or letters.

        Marks at the ends are left out in one reading; in the others they are
        read as letters, from their beginning or from any mark on at the front,
        up to each of the marks at the back.  Two look-alikes side by side are
        one letter or two, whichever is likelier, and again two.
        """
        begin, end = 0, len(piece)
        while begin < end and is_mark(piece[begin]):
            begin += 1
        while end > begin and is_mark(piece[end - 1]):
            end -= 1
        front, middle, back = piece[:begin], piece[begin:end], piece[end:]
        twice = any(m[1] in LOOKS for m in REPEATED.finditer(piece))
        for doubled in (False, True) if twice else (False,):
            starts = [START]
            for anew in (False, True):
                found = list(self.through(START, front, doubled, anew))
                if found and middle:
                    starts.append(found[-1][1])
                elif found:
                    yield from (self.best(read) for read, _ in found)
                if len(found) < 2:
                    break
            steps = self.lattice(middle, doubled)
            for paths in starts if middle else ():
                for options in steps:
                    paths = self.step(paths, options)
                yield self.best(paths)
                yield from (self.best(read) for read, _ in self.through(paths, back, doubled) if read)


def looking(run: str, doubled: bool) -> list[tuple[str, float]]:
    """What a run of one character looks like, with its cost."""
    options = []
    for look in LOOKS.get(run[0], ""):
        if len(run) != 2 or not doubled:
            options.append((look, LOOK_ALIKE + (0.3 if len(run) > 1 else 0.0)))
        if len(run) == 2:
            options.append((look * 2, LOOK_ALIKE))
    return options


def is_mark(char: str) -> bool:
    """Neither a letter, a digit, an underscore nor white space."""
    return not (char.isalnum() or char == "_" or char.isspace())


def legible(piece: str) -> bool:
    """Something in it is a letter or looks like one."""
    return any(c.isalpha() or c in LOOKS for c in piece)


def spans(text: str) -> set[str]:
    """Characters and short groups set apart, one space between them."""
    found = set()
    for match in SPLIT.finditer(text):
        found.add(" ".join(match[0].split()))
        # Where the groups are single characters, these are read by themselves too.
        found.update(" ".join(inner[0].split()) for inner in SPACED.finditer(text, *match.span()))
    return {span for span in found if legible(span)}


def simplified(piece: str) -> str:
    """Compatibility forms written plainly, invisible characters left out."""
    if piece.isascii():
        return piece
    plain = unicodedata.normalize("NFKC", piece).lower()
    return "".join(c for c in plain if unicodedata.category(c) != "Cf")


class Reader:
    """Words of a piece of text as it stands and as restored."""

    def __init__(self, language: np.ndarray):
        self.restore = Restorer(language)

    def words(self, piece: str) -> set[str]:
        piece = simplified(piece)
        found = set(WORDS.findall(piece))
        core = piece.strip(".,;:?\"'()[]{}…«»")
        if not legible(core):
            return found
        if len(found) == 1 and core in found and not REPEATED.search(core) and not any(c in LOOKS for c in core):
            return found
        return found.union(*map(WORDS.findall, self.restore.readings(core)))

    def span(self, span: str, begins: list[int] | None = None) -> set[str]:
        """Words of one of ``spans``: of all of it, and again from each group on, or those of ``begins``.

        What stands before a word can draw its beginning to itself.
        """
        groups = span.split(" ")
        found = set(WORDS.findall(self.restore(simplified(span))))
        for i in range(1, len(groups) - 1) if begins is None else begins:
            found.update(WORDS.findall(self.restore(simplified(" ".join(groups[i : i + AHEAD])))))
        return found


def stems(word: str) -> list[str]:
    """A word and its beginnings."""
    return [f"={word}", *[f"{n}{word[:n]}" for n in BEGINNINGS if len(word) >= n]]


def features(counts: dict[str, int], size: int) -> list[str]:
    """Stems as they are, and again where they are dense: one in so many of the text's different pieces.

    A stem that turns up once in a very long text says less than in a short one.
    """
    return [
        name
        for stem, count in counts.items()
        for name in (stem, *[f"{stem}~{density}" for density in DENSITIES if count * density >= size])
    ]


def held_out(key: Column) -> Column:
    """Rows never learnt from: crc32 of the key as text leaves 1 by 3."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_weights(rows: list[tuple[list[int], int]], names: list[str]) -> tuple[dict[str, float], float]:
    """Logistic regression over present features (a bounded sample, on the driver).

    Both classes weigh the same; steps are scaled per weight by the size of its
    past slopes.
    """
    labels = np.array([label for _, label in rows], float)
    positive = labels.sum()
    if not len(labels) or positive in (0, len(labels)):
        return {}, math.log(3) if positive else -math.log(99)
    share = np.where(labels == 1, 0.5 / positive, 0.5 / (len(labels) - positive))
    which = np.concatenate([np.full(len(f), i) for i, (f, _) in enumerate(rows)]).astype(np.int64)
    column = np.array([f for present, _ in rows for f in present], np.int64)
    weights = np.zeros(len(names) + 1)
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, 1201):
        logits = np.bincount(which, weights[column], minlength=len(labels)) + weights[-1]
        wrong = share * (1 / (1 + np.exp(-np.clip(logits, -30, 30))) - labels)
        slope = np.append(np.bincount(column, wrong[which], minlength=len(names)), wrong.sum())
        slope[:-1] += 5e-6 * weights[:-1]
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        weights -= 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return dict(zip(names, weights[:-1].tolist())), float(weights[-1])


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    max_labelled: int = 20_000,
    max_features: int = 1_000,
    key: str = "doc_id",
    text: str = "text",
) -> Model:
    """Language model of all documents; word weights from labelled ones.

    At most ``max_labelled`` labelled documents (chosen by the hash of their
    key and content, repeated rows once) are used, none of them held out.  Labels other than 0 and 1 and rows
    without a key are left out; the larger of several labels counts.  Only the
    text is an input.  Without labelled rows of both classes all texts get one
    score: 0.75 where all rows seen are toxic, else 0.01.
    """
    spark = docs.sparkSession
    small_batches(spark)
    language = language_model(docs, text)
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
    known = known.filter(F.col("label").isin(0, 1) & F.col("key").isNotNull() & ~held_out(F.col("key")))
    chosen = known.groupBy("key").agg(F.max("label").alias("label")).orderBy(F.xxhash64("key"), "key").limit(max_labelled)
    texts = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # The keys are bounded, so they may be broadcast; a repeated row counts once.  Written once, as it is read twice.
    found = texts.join(F.broadcast(chosen), "key").distinct()
    # The default partitions, as small ones put together would leave decoding to a few tasks.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    contents = cut_lineage(found.withColumn("content", F.xxhash64("text")).repartition(parts, "key", "content"))
    # A key may have many contents, so rows are bounded again.
    order = (F.xxhash64("key"), "key", "content")
    kept = contents.select("key", "content").orderBy(*order).limit(max_labelled)
    sample = contents.join(F.broadcast(kept), ["key", "content"], "left_semi").select("text", "label")
    shared = spark.sparkContext.broadcast(language)

    def present(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(shared.value)
        memory: dict[str, tuple[str, ...]] = {}
        for batch in batches:
            for at in range(0, len(batch), 64):
                # Features of a few documents at a time: they take many times the room of the text.
                out = []
                part = batch.iloc[at : at + 64]
                for body, mark in zip(part["text"], part["label"]):
                    body = body.lower()
                    words: set[str] = set()
                    pieces = set(body.split())
                    if len(memory) > HELD:
                        memory.clear()
                    for read, parts in ((reader.span, spans(body)), (reader.words, pieces)):
                        for part in parts:
                            if (found := memory.get(part)) is None:
                                found = tuple(read(part))
                                if len(part) <= LONGEST:
                                    memory[part] = found
                            words.update(found)
                    counts = Counter(stem for word in words for stem in stems(word))
                    out.append((features(counts, len(pieces)), mark))
                yield pd.DataFrame(out, columns=["features", "label"])

    read = cut_lineage(sample.mapInPandas(present, "features array<string>, label int"))
    toxic = F.sum(F.when(F.col("label") == 1, 1).otherwise(0))
    # Features of toxic documents, by how far their presence and the label go together.
    sizes = read.agg(F.count(F.lit(1)).alias("n"), F.coalesce(toxic, F.lit(0)).alias("t")).first()
    # What a hundredth of the toxic documents share is no accident of a few copies.
    least = max(3, sizes["t"] // 100)
    seen = read.filter("label = 1").select(F.explode("features").alias("f")).groupBy("f").count()
    seen = seen.filter(F.col("count") >= least)
    counts = (
        read.select("label", F.explode("features").alias("f"))
        .join(seen.select("f"), "f", "left_semi")
        .groupBy("f")
        .agg(toxic.alias("t"), F.count(F.lit(1)).alias("n"))
    )
    names: list[str] = []
    if sizes["t"]:
        rate = sizes["t"] / sizes["n"]
        gain = F.col("t") * F.log(F.col("t") / (F.col("n") * rate))
        # Only what stands in toxic documents more often than not.
        best = counts.filter(F.col("t") > F.col("n") * (0.5 + rate / 2)).orderBy(gain.desc(), "f").limit(max_features)
        names = [r["f"] for r in best.select("f").collect()]
    number = {name: i for i, name in enumerate(names)}
    # Of each sampled document only the chosen features come to the driver.
    wanted = spark.createDataFrame([(n, i) for n, i in number.items()], "f string, i int")
    marked = read.withColumn("row", F.monotonically_increasing_id())
    hits = (
        marked.select("row", F.explode("features").alias("f"))
        .join(F.broadcast(wanted), "f")
        .groupBy("row")
        .agg(F.collect_list("i").alias("i"))
    )
    rows = marked.select("row", "label").join(hits, "row", "left").select("label", "i").collect()
    weights, intercept = fit_weights([(r["i"] or [], r["label"]) for r in rows], names)
    return Model(language, {f: w for f, w in weights.items() if w}, intercept)


class Spelling:
    """Whether the lattice of a piece can spell a word that begins with one of some strings.

    The strings form a tree, and the lattice is run through it as an automaton,
    with every option that any reading of the piece has and no costs.  Where it
    finds nothing, no reading has such a word, so nothing need be decoded.
    """

    def __init__(self, begins: set[str]):
        self.root: dict = {}
        for begin in begins:
            node = self.root
            for char in begin:
                node = node.setdefault(char, {})
            node[""] = True
        #: Nodes that a run of up to three of a character leads to from the root.
        self.first: dict[tuple[str, int], list[dict]] = {}

    @staticmethod
    def read(char: str, length: int) -> set[str]:
        """The letters a run can stand for; nothing where it can be left out.  A gap ends the word and is not listed."""
        looks = LOOKS.get(char, "")
        found = {out for look in looks for out in ((look, look * 2) if length == 2 else (look,))}
        if char.isalpha():
            found |= {char * length, char, char * min(length, 2)}
        elif not char.isalnum():
            found.add("")
        return found

    @staticmethod
    def walk(node: dict, out: str) -> dict | None:
        """The node behind ``out``; the node of a whole string where one ends on the way."""
        for char in out:
            node = node.get(char)
            if node is None or "" in node:
                return node
        return node

    def step(self, nodes: list[dict], char: str, length: int) -> list[dict]:
        """Nodes that a run leads to; left out, it keeps every node but the root, which comes again by itself."""
        reached = {}
        for out in self.read(char, length):
            for node in nodes:
                found = self.walk(node, out)
                if found is not None and found is not self.root:
                    reached[id(found)] = found
        if char in HIDING:
            hidden = nodes
            for _ in range(length):
                hidden = [after for node in hidden for letter, after in node.items() if letter]
                reached.update((id(node), node) for node in hidden if "" in node)
            reached.update((id(node), node) for node in hidden)
        return list(reached.values())

    def __call__(self, piece: str) -> bool:
        nodes: list[dict] = []
        begins = True
        for run in RUN.finditer(piece):
            char = run[1]
            if begins or nodes:
                key = char, run.end() - run.start()
                reached = self.step(nodes, *key) if nodes else []
                if begins:
                    first = self.first.get(key)
                    if first is None:
                        first = self.step([self.root], *key)
                        if key[1] <= 3:
                            self.first[key] = first
                    reached = reached + first
                if any("" in node for node in reached):
                    return True
                nodes = list(reached)
            # A word begins with the piece, or behind a mark or a digit, which may be a gap or left out.
            begins = not char.isalpha()
        return False


class Scorer:
    """Score of whole texts; the words that matter in a piece of text are remembered."""

    def __init__(self, model: Model):
        self.model, self.reader = model, Reader(model.language)
        self.stems = {name.split("~")[0] for name in model.weights}
        self.memory: dict[str, tuple[str, ...]] = {}
        #: What a telling word is or begins with, and the same with doubled letters once.
        self.told = {stem[1:] for stem in self.stems}
        self.folded = {REPEATED.sub(r"\1", told) for told in self.told}
        self.lengths = sorted({len(told) for told in self.told | self.folded})
        self.spells = Spelling(self.told)
        self.equal = {stem[1:] for stem in self.stems if stem[0] == "="}
        self.begin = [{stem[1:] for stem in self.stems if stem[0] == str(n)} for n in BEGINNINGS]

    def telling(self, words: Iterable[str]) -> tuple[str, ...]:
        """Words with a stem that has a weight."""
        (a, b, c), (four, five, six), equal = BEGINNINGS, self.begin, self.equal
        # A shorter word is none of the beginnings of that length.
        return tuple(w for w in words if w in equal or w[:a] in four or w[:b] in five or w[:c] in six)

    def read(self, piece: str) -> tuple[str, ...]:
        """The telling words of a piece as it stands and as restored.

        A Latin word can be read only with or without its doubled letters; if
        none of these readings tells anything, it need not be decoded.
        """
        plain = LATIN.fullmatch(piece)
        if plain and not REPEATED.search(plain[1]):
            return self.telling((plain[1],))
        if plain and not TRIPLE.search(plain[1]):
            first, *rest = REPEATED.split(plain[1])
            if len(rest) <= 8:
                readings = [first]
                for letter, after in zip(rest[::2], rest[1::2]):
                    readings = [r + out + after for r in readings for out in (letter * 2, letter)]
                if not self.telling(readings):
                    return ()
        simple = simplified(piece)
        if not self.spells(simple):
            return self.telling(set(WORDS.findall(simple)))
        return self.telling(self.reader.words(piece))

    def begins(self, span: str) -> list[int]:
        """Groups of a span that can begin like a telling word, those behind put to them.

        Latin groups can be read only as they are, put together, and with or
        without doubled letters.
        """
        groups = span.split(" ")
        joined = "".join(groups)
        if not LATIN_GROUPS.fullmatch(span) or TRIPLE.search(joined):
            return list(range(len(groups)))
        found = []
        longest, at = self.lengths[-1] if self.lengths else 0, 0
        for i, group in enumerate(groups):
            ahead, known = joined[at : at + 2 * longest], self.told
            if REPEATED.search(ahead):
                ahead, known = REPEATED.sub(r"\1", ahead), self.folded
            if any(ahead[:length] in known for length in self.lengths):
                found.append(i)
            at += len(group)
        return found

    def read_span(self, span: str) -> tuple[str, ...]:
        """The telling words of short groups put together."""
        if not self.spells(simplified(span)):
            return ()
        begins = self.begins(span)
        return self.telling(self.reader.span(span, begins)) if begins else ()

    def __call__(self, text: str) -> float:
        text = text.lower()
        memory = self.memory
        if len(memory) > REMEMBERED:
            memory.clear()
        pieces, apart = set(text.split()), spans(text)
        words: set[str] = set()
        # A span has white space in it, so it is never a piece.
        for read, parts in ((self.read, pieces), (self.read_span, apart)):
            words.update(*filter(None, map(memory.get, parts)))
            for part in [part for part in parts if part not in memory]:
                found = read(part)
                words.update(found)
                if len(part) <= LONGEST:
                    memory[part] = found
        weights = self.model.weights
        counts = Counter(stem for word in words for stem in stems(word) if stem in self.stems)
        # Added up in one order, so that a text has one score.
        present = sorted(name for name in features(counts, len(pieces)) if name in weights)
        logit = self.model.intercept + sum(map(weights.__getitem__, present))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, logit))))


def score(spark: SparkSession, model: Model, text: Column) -> Column:
    """Score of a text between 0 and 1; NULL counts as empty."""
    # A plain tuple: workers do not have this package.
    shared = spark.sparkContext.broadcast(tuple(model))
    name = f"toxicity {uuid.uuid4().hex}"

    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = remembered(name, lambda: Scorer(Model(*shared.value)))
        for batch in batches:
            yield pd.Series([scorer(body) for body in batch], dtype=float)

    scored.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(scored, "double")(F.coalesce(text, F.lit("")))


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = 0.7,
    key: str = "doc_id",
    text: str = "text",
    **options,
) -> DataFrame:
    """All columns of ``docs`` with ``held_out``, ``score`` and ``predicted`` (1 from ``threshold`` on).

    NULL and empty texts score as a text without words; rows without a key are
    not held out; repeated rows score alike; very long texts are read whole; an
    empty table gives an empty result.  Columns of ``docs`` with one of the
    three names are replaced; ``reject_documents`` keeps them.
    """
    model = train(docs, labels, key=key, text=text, **options)
    scored = docs.withColumns({"held_out": held_out(F.col(key)), "score": score(docs.sparkSession, model, F.col(text))})
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def reject_documents(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.7, key: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, all their columns as they are, whatever their names."""
    model = train(docs, labels, key=key, text=text, **options)
    return docs.filter(score(docs.sparkSession, model, F.col(text)) < threshold)
