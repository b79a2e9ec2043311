"""N-gram Jaccard join by a token-group matrix: which documents share most of their word shingles.

Words are runs without ASCII white space, A-Z lower-cased; a document's set holds its different shingles of ``width``
words (the whole sequence, if shorter) as 64-bit hashes. Two sets link when 100 * |a & b| >= ``percent`` * |a | b|.
The join is exact; its result is the components of the links.

1. Equal sets fall together into classes.
2. Tokens get one global order, rare ones first, from a count sketch over all documents (fixed size, summed over the
   tasks). Sets that link share at least ``SHARED`` tokens among the first few of both (the prefix).
3. Classes with the same minimum hash meet in blocks of bounded size and are linked there; the leaders of the pieces
   meet again while blocks are many. What is linked so far is a *piece*; it is split into *groups* of at most about
   ``MEMBERS`` classes. Classes that are linked with nothing yet share a group with those of their block.
4. Token-group matrix: which groups hold which prefix token. Tokens that only one class has are dropped first.
5. The union of all tokens of a group is stored. A query meets groups with which it shares enough prefix tokens; the number
   of its tokens in the union bounds its overlap with every member. Only groups whose bound reaches the query's least
   overlap are opened, and their members compared.
6. Step 5 is done for few pairs first (``STARS`` rounds): under every token all classes of about one size ask one group
   of the largest piece there, which joins the pieces of near copies; then for all that is left, where of two the smaller
   asks.
   Classes of one piece are never compared again, so a large group of near copies costs about as much as its rows.

A token, class, group or minimum hash with many rows is split: partial counts, ranges, blocks by hash, queries by block.
Texts of the classes that are asked for are found by a bitmap of fixed size over their keys before they are shuffled.

Edge cases: null or empty texts have the empty set and link with nothing; equal rows and equal sets are one class;
rows of one id (or without an id) with several texts are joined each by their own text; null ids are carried along and
never name a component; very long texts are cut into shingles whole; columns beside ``doc_id`` and ``text`` are left
out, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .ordered import in_order
from .tables import Shared, bounded_batches, discard, lean, materialize, slices

SKETCH_BITS, PARTS = 20, 64
LOCAL, MEMBERS, QUERIES = 256, 256, 512
ROUNDS, STARS = 4, 1
#: Prefix tokens that two sets must share: each further one makes prefixes a token longer, and chance meetings rarer.
SHARED = 5
#: Bytes of sets that meet in one call.
BUCKET = 8 << 20
#: Bits of the bitmap over the keys of wanted texts, and of one of its rows.
KEY_BITS, ROW_BITS = 26, 15
MEMORY = 300_000
M = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


class Shingles:
    """Sorted shingle hashes of whole texts; remembers words between calls."""

    def __init__(self, width: int):
        self.width, self.hashes = width, _Hashes()

    def __call__(self, text: str | None) -> np.ndarray:
        return np.unique(self.all(text))

    def all(self, text: str | None) -> np.ndarray:
        """One hash per shingle, in order of the text."""
        words = text.encode("utf-8", "replace").lower().split() if text else []
        if not words:
            return np.zeros(0, np.uint64)
        n = len(words) - self.width + 1
        if n < 1:
            return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], dtype=np.uint64)
        if len(self.hashes) > MEMORY:
            self.hashes.clear()
        h = np.fromiter(map(self.hashes.__getitem__, words), np.uint64, len(words))
        out = np.zeros(n, np.uint64)
        for k in range(self.width):
            out = (out ^ (out >> np.uint64(29))) * M + h[k : k + n]
        out = (out ^ (out >> np.uint64(32))) * M
        return out ^ (out >> np.uint64(29))


def least_overlap(n, percent: int):
    return -(-percent * n // 100)


def _sketch(docs: DataFrame, width: int) -> np.ndarray:
    """How often the tokens of each of 2**SKETCH_BITS slots occur: a level of one byte, which alone reaches the driver."""
    size = 1 << SKETCH_BITS

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles, total = Shingles(width), np.zeros(size, np.int32)
        for pdf in batches:
            for i, j in slices([len(t or "") for t in pdf["text"]], 4 << 20):
                found = np.concatenate([shingles.all(t) for t in pdf["text"].iloc[i:j]])
                total += np.bincount((found >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=size).astype(np.int32)
        if total.any():
            yield pd.DataFrame({"part": range(PARTS), "counts": [x.tobytes() for x in np.split(total, PARTS)]})

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for pdf in batches:
            for part, counts in zip(pdf["part"], pdf["counts"]):
                total[part] = total.get(part, 0) + np.frombuffer(counts, np.int32).astype(np.int64)
        levels = [np.minimum(np.log2(x + 1) * 6, 255).astype(np.uint8).tobytes() for x in total.values()]
        yield pd.DataFrame({"part": list(total), "counts": levels})

    schema = "part int, counts binary"
    out = np.zeros(size, np.uint8)
    for r in docs.select("text").mapInPandas(lean(count), schema).repartition(PARTS // 4, "part").mapInPandas(add, schema).collect():  # PARTS rows
        out[r["part"] * (size // PARTS) : (r["part"] + 1) * (size // PARTS)] = np.frombuffer(r["counts"], np.uint8)
    return out


def _profiles(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc, ver, n, cls, least, prefix): hash of the text, size, digest of the set, its minimum hash, first tokens in the global order."""
    shared = Shared(docs.sparkSession, _sketch(docs, width))  # of fixed size

    def profile(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles, level = Shingles(width), shared.value
        for pdf in batches:
            n, cls, least, prefix = [], [], [], []
            for text in pdf["text"]:
                s = shingles(text)
                n.append(len(s))
                cls.append(xxhash.xxh3_128_digest(s.tobytes()))
                if len(s):
                    mixed = s * M
                    least.append(int((mixed ^ (mixed >> np.uint64(31))).min().view(np.int64)))
                    key = (level[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (s >> np.uint64(8))
                    first = min(len(s), len(s) - least_overlap(len(s), percent) + SHARED)
                    at = np.argpartition(key, first - 1)[:first]
                    prefix.append(s[at[np.argsort(key[at])]].tobytes())
                else:
                    least.append(0)
                    prefix.append(b"")
            yield pd.DataFrame({"doc": pdf["doc_id"], "ver": pdf["ver"], "n": n, "cls": cls, "least": least, "prefix": prefix})

    return docs.select("doc_id", F.xxhash64("text").alias("ver"), "text").mapInPandas(lean(profile), "doc long, ver long, n long, cls binary, least long, prefix binary")


def _key(doc, ver):
    return F.pmod(F.xxhash64(doc, ver), F.lit(1 << KEY_BITS))


def _sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """wanted (cid, doc, ver, ...) -> its columns but doc and ver, with the whole set of each class.

    The bitmap of wanted keys (8 MB at most) lets few other texts through; the join by id and version decides.
    """
    bits = wanted.select(_key("doc", "ver").alias("k")).groupBy(F.shiftright("k", ROW_BITS).alias("bucket")).agg(F.bitmap_construct_agg(F.col("k").bitwiseAND(F.lit((1 << ROW_BITS) - 1))).alias("map"))
    rows = docs.select(F.col("doc_id").alias("of_doc"), F.xxhash64("text").alias("of_ver"), "text").withColumn("k", _key("of_doc", "of_ver"))
    rows = rows.join(F.broadcast(bits), F.shiftright("k", ROW_BITS) == F.col("bucket"))  # of fixed size
    place = F.col("k").bitwiseAND(F.lit((1 << ROW_BITS) - 1)).cast("int")
    byte = F.conv(F.hex(F.substring("map", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    # equal rows are one text; the join has the keys of the grouping, a null id as one of them, so texts are shuffled once
    keys = lambda doc, ver: {"of_id": F.coalesce(doc, F.lit(0).cast("long")), "of_none": F.isnull(doc), "of_ver": F.col(ver)}
    rows = rows.where(F.getbit(byte, place % 8) == 1).withColumns(keys("of_doc", "of_ver")).groupBy("of_id", "of_none", "of_ver").agg(F.first("text").alias("text"))
    columns = [c for c in wanted.columns if c not in ("doc", "ver")]
    found = wanted.withColumns(keys("doc", "ver")).join(rows, ["of_id", "of_none", "of_ver"]).select("text", *columns)

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingles(width)
        for pdf in batches:
            yield pdf.assign(tokens=[shingles(t).tobytes() for t in pdf["text"]]).drop(columns="text")

    return found.mapInPandas(lean(make), found.drop("text").schema.add("tokens", "binary"))


def _buckets(rows: DataFrame, size) -> int:
    """How many groups of about BUCKET bytes the rows make: a Python call for each small group would cost more than its work."""
    return max(1, -(-int(rows.agg(F.sum(size)).first()[0] or 0) // BUCKET))


def _link_local(tokens: list[bytes], percent: int) -> np.ndarray:
    """Smallest place of the piece of each set; every two sets that are not yet linked are compared."""
    sets = [np.frombuffer(t, np.uint64) for t in tokens]
    sizes = np.array([len(s) for s in sets])
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
    starts = np.cumsum(sizes) - sizes
    piece = np.arange(len(sets))
    present = np.zeros(ids.max() + 1, np.int32)
    for i in range(len(sets)):
        if (piece == piece[0]).all():
            break
        own = ids[starts[i] : starts[i] + sizes[i]]
        present[own] = 1
        both = np.add.reduceat(present[ids], starts)
        present[own] = 0
        hit = np.isin(piece, piece[100 * both >= percent * (sizes + sizes[i] - both)])
        piece[hit] = piece[hit].min()
    return piece


def _pieces(docs: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame | None:
    """Links (a, b) between classes of the same minimum hash."""
    met = classes.groupBy("least").agg(F.count("*").alias("met")).where("met > 1")
    block = F.pmod(F.xxhash64("cid"), F.ceil(F.col("met") / LOCAL))
    wanted = materialize(classes.join(met, "least").select("cid", "doc", "ver", "least", "met"), "wanted")
    now, links = materialize(_sets(docs, wanted, width), "sets"), None
    discard(wanted)

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("cid").sort_values("cid").reset_index(drop=True)
        piece = np.arange(len(pdf))
        for rows in pdf.groupby(["least", "block"]).indices.values():
            if len(rows) > 1:
                piece[rows] = rows[_link_local([pdf["tokens"][i] for i in rows], percent)]
        again = (piece == np.arange(len(pdf))) & (pdf["met"].to_numpy() > LOCAL)
        return pd.DataFrame({"a": pdf["cid"], "b": pdf["cid"].to_numpy()[piece], "least": pdf["least"], "met": pdf["met"], "tokens": pdf["tokens"].where(again, None)})

    for _ in range(ROUNDS):
        blocks = now.withColumn("block", block).withColumn("bucket", F.pmod(F.xxhash64("least", "block"), F.lit(_buckets(now, F.length("tokens")))))
        done = blocks.groupBy("bucket").applyInPandas(link, "a long, b long, least long, met long, tokens binary")
        done = materialize(done, "linked")
        discard(now)
        found = done.where("a <> b").select("a", "b")
        links = found if links is None else links.unionAll(found)
        left = done.where("tokens is not null").select(F.col("a").alias("cid"), "least", "met", "tokens")
        size = left.groupBy("least").agg(F.count("*").alias("now"), F.max("met").alias("before"))
        # leaders meet again where blocks were many and linking made them fewer
        fewer = size.where(F.col("now") * 2 < F.col("before")).select("least", "now")
        if fewer.isEmpty():
            break
        now = materialize(left.drop("met").join(fewer, "least").select("cid", "least", F.col("now").alias("met"), "tokens"), "leaders")
    return links


def _common_tokens(classes: DataFrame, percent: int) -> DataFrame:
    """(token, cid, indexed) of the prefix tokens that more than one class has (and of a few others at the ends of partitions).

    indexed: also among the first tokens that matter towards larger sets. Of two sets that link the smaller one shares
    a token among fewer of its first ones: twice the percentage of its size over 100 + percent.
    """

    def explode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            tokens = [np.frombuffer(p, np.int64) for p in pdf["prefix"]]
            sizes, n = np.array([len(t) for t in tokens]), pdf["n"].to_numpy()
            short = n - -(-2 * percent * n // (100 + percent)) + SHARED
            place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            yield pd.DataFrame({"token": np.concatenate(tokens), "ref": np.repeat(pdf["cid"].to_numpy(), sizes) * 2 + (place < np.repeat(short, sizes))})

    def repeated(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Of sorted rows those with a neighbour of the same token; the first and the last row may have one in another partition."""
        last, stays = None, True
        for pdf in batches:
            token = pdf["token"].to_numpy()
            same = token[1:] == token[:-1]
            begins = last is None or token[0] == last["token"].iloc[0]
            keep = np.append(begins, same) | np.append(same, False)
            if last is not None and (stays or begins):
                yield last
            yield pdf[:-1][keep[:-1]]
            last, stays = pdf[-1:], bool(keep[-1])
        if last is not None:
            yield last

    rows = classes.select("cid", "n", "prefix").mapInPandas(explode, "token long, ref long")
    return in_order(rows, ["token", "ref"], []).mapInPandas(repeated, "token long, ref long")


def _group(classes: DataFrame, pieces: DataFrame) -> DataFrame:
    """(cid, doc, ver, n, name, part, members, unit): the group (name, part) of each class.

    A piece of ``members`` classes has even parts. Classes that are linked with nothing yet share a group, of an odd
    part, with those of the same minimum hash with which they were compared. Within a unit, a piece or such a group,
    nothing is left to compare.
    """
    sizes = pieces.groupBy("component").agg(F.count("*").alias("members"))
    of = pieces.join(sizes, "component").select(F.col("id").alias("cid"), F.col("component").alias("piece"), "members")
    met = classes.groupBy("least").agg(F.count("*").alias("met"))
    rows = classes.select("cid", "doc", "ver", "n", "least").join(met, "least").join(of, "cid", "left")
    linked, place = F.col("piece").isNotNull(), F.xxhash64("cid")
    name = F.coalesce("piece", "least").alias("name")
    part = F.when(linked, F.pmod(place, F.ceil(F.col("members") / MEMBERS)) * 2).otherwise(F.pmod(place, F.ceil(F.col("met") / LOCAL)) * 2 + 1)
    grouped = rows.select("cid", "doc", "ver", "n", name, part.alias("part"), F.coalesce("members", F.lit(1)).alias("members"))
    return grouped.withColumn("unit", F.when(F.col("part") % 2 == 0, -1).otherwise(F.col("part")))


def _token_rows(tokens: DataFrame, grouped: DataFrame) -> DataFrame:
    """Token rows with the class, its size and its group."""
    rows = tokens.join(grouped.select("cid", "n", "name", "part", "members", "unit"), F.shiftright("ref", 1) == F.col("cid"))
    return materialize(rows.select("token", "ref", "cid", "n", "name", "part", "members", "unit"), "token-groups")


def _in_several(rows: DataFrame, by: list[str], *more) -> DataFrame:
    """Of the values of ``by`` those that lie in several units."""
    unit = F.struct("name", "unit")
    return rows.groupBy(*by).agg(F.min(unit).alias("low"), F.max(unit).alias("high"), *more).where("low <> high")


def _some_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """(cid, n, name, part): under each token the classes of about one size ask one group of the largest piece there."""
    rows = rows.withColumn("band", F.floor(F.log("n") / -np.log(percent / 100)).cast("int"))
    hub = F.max(F.struct("members", "name", "part", "unit", F.col("n").alias("size"))).alias("hub")
    hubs = _in_several(rows, ["token", "band"], hub)
    hubs = materialize(hubs.select("token", "band", "hub.size", F.col("hub.name").alias("to_name"), F.col("hub.part").alias("to_part"), F.col("hub.unit").alias("to_unit")), "hubs")
    # plain shuffles on both sides can be split where a token is common
    near = ~_known() & (F.least("n", "size") * 100 >= F.greatest("n", "size") * percent)
    return _often(rows.join(hubs, ["token", "band"]).where(near), percent)


def _known():
    return (F.col("name") == F.col("to_name")) & (F.col("unit") == F.col("to_unit"))


def _often(meetings: DataFrame, percent: int) -> DataFrame:
    """(cid, n, name, part), one row per shared token -> those that share SHARED of them, or as many as they overlap at least."""
    need = F.least(F.lit(SHARED), F.ceil(F.col("n") * percent / 100))
    pairs = meetings.select("cid", "n", F.col("to_name").alias("name"), F.col("to_part").alias("part"))
    return pairs.groupBy("cid", "n", "name", "part").agg(F.count("*").alias("times")).where(F.col("times") >= need).drop("times")


def _every_pair(rows: DataFrame, percent: int) -> DataFrame:
    """(cid, n, name, part): under each token the classes of the smaller of every two units ask the groups of the larger."""
    several = materialize(_in_several(rows, ["token"]).select("token"), "several")
    shared = materialize(rows.join(several, "token"), "shared-tokens")
    own = F.col("ref") % 2 == 1
    to = {c: F.col(c).alias(f"to_{c}") for c in ("name", "part", "members", "unit")}
    groups = shared.groupBy("token", *to.values()).agg(F.min("n").alias("low"), F.max("n").alias("high"), F.min(F.when(own, F.col("n"))).alias("low_indexed"))
    groups = materialize(groups, "matrix")
    asks = (F.struct("members", "name", "unit") < F.struct("to_members", "to_name", "to_unit")) & ~_known()
    # the smaller set of two has the token among its first ones
    larger = own & (F.col("high") >= F.col("n")) & (F.col("low") * percent <= F.col("n") * 100)
    smaller = (F.col("low_indexed") <= F.col("n")) & (F.col("high") * 100 >= F.col("n") * percent)
    return _often(shared.join(groups, "token").where(asks & (larger | smaller)), percent)


def _shares(candidates: DataFrame) -> DataFrame:
    """(name, part, shares): in how many shares of at most about QUERIES queries each group is asked."""
    return materialize(candidates.groupBy("name", "part").agg(F.ceil(F.count("*") / QUERIES).alias("shares")), "shares")


def _meet(candidates: DataFrame, many: DataFrame, asked: DataFrame, groups: DataFrame, compare, schema: str) -> DataFrame:
    """Queries (cid, what) of ``candidates`` (cid, n, name, part) and rows (name, part, shares, cid, what) of the same group meet, a share of ``many`` at a time.

    ``compare`` gets the key of a group, its queries and its rows, many groups in one task.
    """
    rows, mean = candidates.count(), asked.agg(F.avg(F.length("what"))).first()[0] or 0
    bucket = F.pmod(F.xxhash64("name", "part", "share"), F.lit(max(1, -(-int(rows * mean) // BUCKET))))
    queries = candidates.join(many, ["name", "part"]).withColumn("share", F.pmod(F.xxhash64("cid"), F.col("shares"))).join(asked, "cid")
    left = queries.select(bucket.alias("bucket"), "cid", "n", "what", "name", "part", "share")
    share = F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1))
    group = groups.select("name", "part", share.alias("share"), "cid", "what")
    right = group.select(bucket.alias("of"), *[F.col(c).alias(f"of_{c}") for c in ("name", "part", "share", "cid", "what")])

    def run(asked: pd.DataFrame, group: pd.DataFrame) -> pd.DataFrame:
        members, out = group.groupby(["of_name", "of_part", "of_share"]).indices, []
        for key, at in asked.groupby(["name", "part", "share"]).indices.items():
            if key in members:
                out += compare(key, [(asked["cid"][i], asked["n"][i], asked["what"][i]) for i in at], [(group["of_cid"][i], group["of_what"][i]) for i in members[key]])
        return pd.DataFrame(out, columns=[x.split()[0] for x in schema.split(", ")]).astype("int64")

    return left.groupBy("bucket").cogroup(right.groupBy("of")).applyInPandas(run, schema)


def _overlap(tokens: np.ndarray, q: np.ndarray) -> int:
    return int((tokens[np.searchsorted(tokens, q).clip(max=len(tokens) - 1)] == q).sum())


def _unions(members: DataFrame) -> DataFrame:
    """(name, part, shares, cid, what) of the members of groups -> the same columns: the union of all tokens of each group.

    A group of one class keeps its cid, else cid is -1.
    """

    def union(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (name, part), at in pdf.groupby(["name", "part"]).indices.items():
            sets = [np.frombuffer(pdf["what"][i], np.uint64) for i in at]
            out.append((name, part, pdf["shares"][at[0]], pdf["cid"][at[0]] if len(at) == 1 else -1, np.unique(np.concatenate(sets)).tobytes()))
        return pd.DataFrame(out, columns=["name", "part", "shares", "cid", "what"])

    bucket = F.pmod(F.xxhash64("name", "part"), F.lit(_buckets(members, F.length("what"))))
    return members.withColumn("bucket", bucket).groupBy("bucket").applyInPandas(union, "name long, part long, shares long, cid long, what binary")


def _links(docs: DataFrame, grouped: DataFrame, candidates: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) of the queries with members of their groups, found by the bound of the union and then by the sets.

    What a set is for, its group with its shares and whether it asks, is joined before its tokens are there: sets move
    only to where they are compared.
    """
    candidates = materialize(candidates, "candidates")
    many = _shares(candidates)
    inside = grouped.join(many, ["name", "part"]).select("cid", "doc", "ver", "name", "part", "shares", F.lit(False).alias("asks"))
    asking = grouped.join(candidates.select("cid").distinct(), "cid").select("cid", "doc", "ver", "name", "part", F.lit(None).cast("long").alias("shares"), F.lit(True).alias("asks"))
    once = inside.unionAll(asking).groupBy("cid").agg(*[F.max(c).alias(c) for c in ("shares", "asks")], *[F.first(c).alias(c) for c in ("doc", "ver", "name", "part")])
    wanted = materialize(once, "wanted")
    sets = materialize(_sets(docs, wanted, width).withColumnRenamed("tokens", "what"), "sets")
    members = sets.where("shares is not null").select("name", "part", "shares", "cid", "what")
    asked = sets.where("asks").select("cid", "what")
    unions = materialize(_unions(members), "unions")

    def bound(key, asked: list, union: list) -> list:
        (alone, tokens), keep = union[0], []
        tokens = np.frombuffer(tokens, np.uint64)
        for cid, n, what in asked:
            both = _overlap(tokens, np.frombuffer(what, np.uint64))
            if both >= least_overlap(n, percent) and (alone < 0 or 100 * both >= percent * (len(tokens) + n - both)):
                keep.append((cid, n, key[0], key[1]))
        return keep

    def compare(key, asked: list, members: list) -> list:
        found, sets = [], [(i, np.frombuffer(t, np.uint64)) for i, t in members]
        for cid, n, tokens in asked:
            q = np.frombuffer(tokens, np.uint64)
            for i, s in sets:
                if 100 * min(len(s), n) >= percent * max(len(s), n):
                    both = _overlap(s, q)
                    if 100 * both >= percent * (len(s) + n - both):
                        found.append((cid, i))
                        if key[1] % 2 == 0:
                            break  # the group is one piece already
        return found

    qualifying = materialize(_meet(candidates, many, asked, unions, bound, "cid long, n long, name long, part long"), "qualifying")
    discard(unions, wanted, many)
    many = _shares(qualifying)
    opened = members.drop("shares").join(many, ["name", "part"])
    links = materialize(_meet(qualifying, many, asked, opened, compare, "a long, b long"), "links")
    discard(candidates, qualifying, sets, many)
    return links


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """docs (doc_id, text) -> (doc_id, ver, n_shingles, component, component_id): one row per row of docs.

    ver is xxhash64 of the text; component numbers the components (null for empty sets), component_id is the smallest
    id in it, which two components share only if rows of one id have unlike texts.
    """
    bounded_batches(docs.sparkSession)
    rows = materialize(_profiles(docs, width, percent), "profiles")
    one = rows.where("n > 0").groupBy("cls").agg(F.min(F.struct("doc", "ver")).alias("of"), F.min("doc").alias("doc"), F.first("n").alias("n"), F.first("least").alias("least"), F.first("prefix").alias("prefix"))
    one = one.select("cls", F.col("of.doc").alias("doc"), F.col("of.ver").alias("ver"), F.col("doc").alias("smallest"), "n", "least", "prefix")
    classes = materialize(one.withColumn("cid", F.monotonically_increasing_id()), "classes")  # numbered once, as written
    # each text by itself from here on
    slim = materialize(rows.select("doc", "ver", "n", "cls"), "documents")
    discard(rows)
    links = _pieces(docs, classes, width, percent)
    tokens = materialize(_common_tokens(classes, percent), "common-tokens")
    named = materialize(classes.select("cid", "cls", "doc", "ver", "n", "least", "smallest"), "names")
    discard(classes)
    for last in [False] * STARS + [True]:
        grouped = materialize(_group(named, components(links)), "groups")
        rows = _token_rows(tokens, grouped)
        found = _links(docs, grouped, (_every_pair if last else _some_pairs)(rows, percent), width, percent)
        discard(rows, grouped)
        links = links.unionAll(found)
    discard(tokens)
    whole = components(links)
    named = named.join(whole.withColumnRenamed("id", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    smallest = named.groupBy("component").agg(F.min("smallest").alias("component_id"))
    of = named.join(smallest, "component").select("cls", "component", "component_id")
    joined = slim.join(of, "cls", "left")
    return joined.select(F.col("doc").alias("doc_id"), "ver", F.col("n").alias("n_shingles"), "component", F.coalesce("component_id", "doc").alias("component_id"))
