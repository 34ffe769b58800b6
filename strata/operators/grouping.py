"""Overlapping groupings: membership checks and measures, alignment, label clusters, average linkage, upserts by name."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.text import containment
from strata.functions.vector import cosine_distance
from strata.operators.components import components

WIDE_SHARE, ECHO, RESTATES = 0.6, 0.34, 0.55
#: Similarities of clusters that average linkage holds at a time.
STRIP = 4_000_000


def validate(groups: DataFrame, valid: DataFrame) -> DataFrame:
    """Groups (topic, pos, name, members) with a name, the first of each name, and only known members; empty ones drop.
    valid: topic, item."""
    from strata.operators.ingest import first_by

    named = groups.withColumn("name", F.trim(F.coalesce("name", F.lit("")))).where("name <> ''")
    first = first_by(named, ["topic", "name"], ["pos"])
    rows = first.select("topic", "pos", "name", F.explode("members").alias("item")).distinct()
    known = rows.join(valid.select("topic", "item").distinct(), ["topic", "item"], "left_semi")
    return known.groupBy("topic", "pos", "name").agg(F.array_sort(F.collect_set("item")).alias("members"))


def standalone(valid: DataFrame, links: DataFrame) -> DataFrame:
    """Items that no group of their topic has."""
    return valid.select("topic", "item").distinct().join(links.select("topic", "item"), ["topic", "item"], "left_anti")


def measures(valid: DataFrame, links: DataFrame) -> DataFrame:
    """Per topic: items, groups, links, multi_home, standalone, widest, wide, singles, nested. links: topic, name, item."""
    links = links.distinct()
    items = valid.select("topic", "item").distinct().groupBy("topic").agg(F.count("*").alias("items"))
    homes = links.groupBy("topic", "item").agg(F.count("*").alias("k")).groupBy("topic").agg(F.count_if(F.col("k") > 1).alias("multi_home"), F.count("*").alias("housed"), F.sum("k").alias("links"))
    sizes = links.groupBy("topic", "name").agg(F.count("*").alias("size"))
    wide = sizes.join(items, "topic").withColumn("share", F.col("size").cast("double") / F.col("items"))
    per = wide.groupBy("topic").agg(F.count("*").alias("groups"), F.max("size").alias("widest"), F.count_if(F.col("share") >= WIDE_SHARE).alias("wide"), F.count_if(F.col("size") == 1).alias("singles"))
    # a proper subset shares all its items with a larger group: counted through shared items
    shared = links.alias("x").join(links.alias("y"), (F.col("x.topic") == F.col("y.topic")) & (F.col("x.item") == F.col("y.item")) & (F.col("x.name") != F.col("y.name")))
    shared = shared.groupBy(F.col("x.topic").alias("topic"), F.col("x.name").alias("name"), F.col("y.name").alias("other")).agg(F.count("*").alias("both"))
    big = sizes.select("topic", F.col("name").alias("other"), F.col("size").alias("other_size"))
    inside = shared.join(sizes, ["topic", "name"]).join(big, ["topic", "other"]).where("both = size and other_size > size").select("topic", "name").distinct().groupBy("topic").agg(F.count("*").alias("nested"))
    out = items.join(homes, "topic", "left").join(per, "topic", "left").join(inside, "topic", "left").na.fill(0)
    return out.withColumn("standalone", F.col("items") - F.col("housed")).drop("housed")


def echoes(groups: DataFrame) -> DataFrame:
    """Whether a group's name echoes an event's title or restates its topic. groups: name, event_title, topic_title."""
    return groups.withColumn("echoes_event", containment(F.col("name"), F.col("event_title")) >= ECHO).withColumn("restates_topic", containment(F.col("name"), F.col("topic_title")) >= RESTATES)


def jaccards(left: DataFrame, right: DataFrame) -> DataFrame:
    """topic, a, b, jaccard for groups of two groupings that share an item. left, right: topic, name, item."""
    left, right = left.distinct(), right.distinct()
    na = left.groupBy("topic", F.col("name").alias("a")).agg(F.count("*").alias("na"))
    nb = right.groupBy("topic", F.col("name").alias("b")).agg(F.count("*").alias("nb"))
    both = left.withColumnRenamed("name", "a").join(right.withColumnRenamed("name", "b"), ["topic", "item"]).groupBy("topic", "a", "b").agg(F.count("*").alias("both"))
    return both.join(na, ["topic", "a"]).join(nb, ["topic", "b"]).select("topic", "a", "b", (F.col("both").cast("double") / (F.col("na") + F.col("nb") - F.col("both"))).alias("jaccard"))


def alignment(left: DataFrame, right: DataFrame) -> DataFrame:
    """Per topic the mean of best Jaccards, both ways averaged, to 3 places. Groups without a partner count 0."""
    j = jaccards(left, right)

    def side(rows: DataFrame, name: str, out: str) -> DataFrame:
        names = rows.select("topic", F.col("name").alias(name)).distinct()
        best = j.groupBy("topic", name).agg(F.max("jaccard").alias("best"))
        return names.join(best, ["topic", name], "left").groupBy("topic").agg(F.avg(F.coalesce("best", F.lit(0.0))).alias(out))

    both = side(left, "a", "forth").join(side(right, "b", "back"), "topic", "full").na.fill(0.0, ["forth", "back"])
    return both.select("topic", F.round((F.col("forth") + F.col("back")) / 2, 3).alias("alignment"))


def _forest(near: np.ndarray) -> np.ndarray:
    """For each row the first row that links of the symmetric matrix reach."""
    root, left = np.arange(len(near)), np.ones(len(near), bool)
    for start in range(len(near)):
        edge = np.array([start]) if left[start] else np.zeros(0, np.int64)
        left[start] = False
        while len(edge):
            edge = np.flatnonzero(near[edge].any(axis=0) & left)
            left[edge], root[edge] = False, start
    return root


def label_clusters(labels: DataFrame, least: float = 0.80, block: int = 1000) -> DataFrame:
    """label_id, cluster (its smallest label) by links of at least that cosine inside a topic. labels: topic, label_id, vector.

    A topic's labels are dealt to blocks of about `block`; each two blocks meet in one task, which reports a spanning forest
    of its links, never all pairs. A zero vector has no links.
    """
    rows = labels.where("topic is not null and label_id is not null and vector is not null")
    sizes = rows.groupBy("topic").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    dealt = rows.join(sizes, "topic").withColumn("own", F.pmod(F.xxhash64("label_id"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = dealt.select("*", other.alias("other")).select("topic", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "label_id", "vector")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, vectors = pdf["label_id"].to_numpy(), np.stack(pdf["vector"].to_numpy()).astype(np.float64)
        size = np.linalg.norm(vectors, axis=1)
        ids, vectors, size = ids[size > 0], vectors[size > 0], size[size > 0]
        root = _forest(vectors @ vectors.T / (size[:, None] * size) >= least)
        linked = root != np.arange(len(root))
        return pd.DataFrame({"a": ids[root[linked]], "b": ids[linked]})

    linked = components(met.groupBy("topic", "i", "j").applyInPandas(run, "a long, b long"))
    out = labels.select("topic", "label_id").join(linked, F.col("label_id") == F.col("item"), "left")
    return out.select("topic", "label_id", F.coalesce("component", "label_id").alias("cluster"))


def _partners(own: np.ndarray, means: np.ndarray, sizes: np.ndarray, least: float, most_size: int) -> tuple[np.ndarray, np.ndarray]:
    """For the clusters `own` the most similar other one that fits and exceeds `least` (the first of equals), -1 if none."""
    best, near = np.full(len(own), -1), np.full(len(own), -np.inf)
    step = max(1, STRIP // max(len(means), 1))
    for k in range(0, len(own), step):
        rows = own[k : k + step]
        s = means[rows] @ means.T
        s[sizes[rows][:, None] + sizes > most_size] = -np.inf
        s[np.arange(len(rows)), rows] = -np.inf
        at = s.argmax(1)
        top = s[np.arange(len(rows)), at]
        best[k : k + step], near[k : k + step] = np.where(top > least, at, -1), top
    return best, near


def _copies(unit: np.ndarray, least: float, most_size: int) -> list[list[int]]:
    """Rows of one direction have the highest similarity there is, so they merge first, in their order, as far as they fit."""
    groups: dict[bytes | int, list[int]] = {}
    for i, v in enumerate(unit):
        groups.setdefault(v.tobytes() if v.any() and least < 1 else i, []).append(i)
    size = max(most_size, 1)
    return sorted(g[k : k + size] for g in groups.values() for k in range(0, len(g), size))


def average_linkage(vectors: np.ndarray, least: float, most_size: int) -> list[list[int]]:
    """Merges the most similar two clusters while their mean similarity exceeds `least` and the sum of sizes fits. Lists of
    rows, each sorted, in order of their first.

    The mean similarity of two clusters is the product of their mean unit vectors, so that no matrix of pairs is held. A
    merged cluster is never more similar to a third than the nearer of its parts was, nor does it fit where a part did not; so
    two clusters that are each other's best stay so until they merge, and all such pairs merge in one round. A round seeks
    new partners only for merged clusters and for those whose partner has merged.
    """
    if not len(vectors):
        return []
    unit = vectors / np.where((size := np.linalg.norm(vectors, axis=1)) == 0, 1, size)[:, None] + 0.0  # no negative zeros
    members = _copies(unit, least, most_size)
    means = np.stack([unit[m].mean(0) for m in members])
    sizes = np.array([len(m) for m in members])
    done = []
    while len(members):
        best, near = _partners(np.arange(len(members)), means, sizes, least, most_size)
        full = best < 0
        # clusters that can take no more leave the table once they are half of it
        while 2 * full.sum() <= len(full):
            own = np.flatnonzero(best >= 0)
            mutual = own[(best[best[own]] == own) & (own < best[own])]
            if not len(mutual):
                # equal similarities that rounding has put in a ring: the greatest of all merges
                mutual = own[[int(near[own].argmax())]]
            left, right = np.minimum(mutual, best[mutual]), np.maximum(mutual, best[mutual])
            for i, j in zip(left, right):
                means[i] = (sizes[i] * means[i] + sizes[j] * means[j]) / (sizes[i] + sizes[j])
                sizes[i] += sizes[j]
                members[i] = members[i] + members[j]
                members[j], sizes[j], best[j] = [], most_size + 1, -1
            gone = np.concatenate([left, right])
            seek = np.flatnonzero((np.isin(best, gone) | np.isin(np.arange(len(best)), gone)) & (sizes <= most_size))
            best[seek], near[seek] = _partners(seek, means, sizes, least, most_size)
            full = best < 0
        done += [sorted(m) for m, f in zip(members, full) if f and m]
        keep = np.flatnonzero(~full)
        members, means, sizes = [members[i] for i in keep], means[keep], sizes[keep]
    return sorted(done, key=lambda m: m[0])


def cluster_blocks(items: DataFrame, least: float = 0.55, most_size: int = 50) -> DataFrame:
    """block, item, cluster (its smallest item) by average linkage inside each block, of any size. items: block, item, vector.

    One task holds the vectors of a block and a strip of their similarities.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("item", ignore_index=True)
        out = np.zeros(len(pdf), np.int64)
        for m in average_linkage(np.stack(pdf["vector"].to_numpy()).astype(np.float64), least, most_size):
            out[m] = pdf["item"][m[0]]
        return pd.DataFrame({"block": pdf["block"], "item": pdf["item"], "cluster": out})

    return items.select("block", "item", "vector").groupBy("block").applyInPandas(run, "block long, item long, cluster long")


def apply_increments(groups: DataFrame, steps: DataFrame) -> DataFrame:
    """Group memberships after additions in any number of steps: existing names grow, new names appear. topic, name, item."""
    return groups.select("topic", "name", "item").unionByName(steps.select("topic", "name", "item")).where("trim(name) <> ''").distinct()


def upsert_by_name(old: DataFrame, new: DataFrame) -> DataFrame:
    """What a regeneration does to groups matched by (topic, name): keep (with the old id), insert or delete."""
    both = old.select("topic", "name", "group_id").withColumn("_o", F.lit(True)).join(new.select("topic", "name").distinct().withColumn("_n", F.lit(True)), ["topic", "name"], "full")
    return both.select("topic", "name", "group_id", F.when(F.col("_o") & F.col("_n"), "keep").when(F.col("_n"), "insert").otherwise("delete").alias("action"))
