"""The eight social-network reports over people, access logs and associates.

Inputs use the canonical column names of :mod:`tessera.sources.delimited`:
people (id, name, nationality, country_code, hobby); logs (acc_id, by_who,
what_page, type_of_access, access_time text); associates (rel_id, person_a,
person_b, ...).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.fixed import LATEST_ACCESS_MIN, NATIONALITY, TOP_PAGES
from tessera.functions.scalar import text_to_int
from tessera.operators import graph
from tessera.operators.joins import checked_broadcast
from tessera.session import ensure_checkpoint_dir

#: digits that fit a bigint together with their count
DIGITS = 16

def nationality_people(people: DataFrame, nationality: str = NATIONALITY) -> DataFrame:
    """Q-A: name and hobby of the people of one nationality."""
    return people.where(F.col("nationality") == F.lit(nationality)).select("name", "hobby")


def page_access_counts(logs: DataFrame) -> DataFrame:
    """(id = page, access_count) -- a bag COUNT skips rows whose first field is null."""
    return logs.groupBy(F.col("what_page").alias("id")).agg(F.count("acc_id").alias("access_count"))


def top_pages(people: DataFrame, logs: DataFrame, k: int = TOP_PAGES) -> DataFrame:
    """Q-B: the k most accessed pages that belong to a person: (id, name,
    nationality).  Ties go to the smaller id, to be deterministic."""
    counts = page_access_counts(logs)
    joined = counts.join(checked_broadcast(people.select("id", "name", "nationality")), "id", "inner")
    return (joined.orderBy(F.col("access_count").desc(), F.col("id").asc())
            .limit(k).select("id", "name", "nationality"))


def people_per_nationality(people: DataFrame) -> DataFrame:
    """Q-C: (nationality, citizen_count); counts are 64-bit throughout."""
    return people.groupBy("nationality").agg(F.count("id").alias("citizen_count"))


def relationship_degree(people: DataFrame, associates: DataFrame) -> DataFrame:
    """Q-D: (owner_name, happiness_factor) for every person, 0 without relations."""
    deg = graph.degree(associates, count_name="relationship_count")
    j = people.select("id", "name").join(deg, "id", "left")
    return j.select(F.col("name").alias("owner_name"),
                    F.coalesce(F.col("relationship_count"), F.lit(0).cast("bigint")).alias("happiness_factor"))


def access_profile(people: DataFrame, logs: DataFrame) -> DataFrame:
    """Q-E: (owner_name, total_accesses, distinct_pages_accessed), 0 when none."""
    per_user = logs.groupBy(F.col("by_who").alias("id")).agg(
        F.count("acc_id").alias("total_accesses"),
        F.countDistinct("what_page").alias("distinct_pages_accessed"))
    j = people.select("id", "name").join(per_user, "id", "left")
    return j.select(F.col("name").alias("owner_name"),
                    F.coalesce("total_accesses", F.lit(0).cast("bigint")).alias("total_accesses"),
                    F.coalesce("distinct_pages_accessed", F.lit(0).cast("bigint")).alias("distinct_pages_accessed"))


def friend_page_visits(associates: DataFrame, logs: DataFrame) -> DataFrame:
    """Middle of Q-F: distinct (id, friend_id) relations where the person
    opened the friend's page.  Two-key equi-join, so no one-key fan-out."""
    pairs = graph.pair_multiplicity(graph.symmetric_edges(associates)).select("id", "friend_id")
    return pairs.join(graph.visited_pairs(logs), ["id", "friend_id"], "left_semi")


def unvisited_friends(people: DataFrame, associates: DataFrame, logs: DataFrame,
                      piece_rows: int = graph.PIECE_ROWS) -> DataFrame:
    """Q-F: (id, name, friend_id, friend_name) for every relation, in both
    directions and once per copy, whose first person never opened the
    second one's page; both ends must be known people."""
    pairs = graph.pair_multiplicity(graph.symmetric_edges(associates))
    unvisited = pairs.join(graph.visited_pairs(logs), ["id", "friend_id"], "left_anti")
    pieces = graph.split_multiplicity(unvisited, "mult", piece_rows)
    names = checked_broadcast(people.select("id", "name"))
    friend = names.select(F.col("id").alias("friend_id"), F.col("name").alias("friend_name"))
    named = pieces.join(friend, "friend_id", "inner").join(names, "id", "inner")
    out = graph.expand_pieces(named, spread_keys=["id", "friend_id"])
    return out.select("id", "name", "friend_id", "friend_name")


def _latest_text(logs: DataFrame) -> DataFrame:
    """(id, latest): each page's largest access time as text, for any texts.

    Spark can only sort for the maximum of a string.  So whole numbers of up
    to 16 digits and no leading zero, which is what the log holds, are
    combined as numbers of the same order: the digits filled up with zeros,
    then their count.  Any other text is a group of its own.  The text maximum
    is taken over what is left, one row a page where all texts are numbers.
    """
    time, size = F.col("access_time"), F.length("access_time")
    power = F.array(*[F.lit(10 ** i).cast("bigint") for i in range(DIGITS)])
    number = time.try_cast("bigint")
    # as many characters as digits: neither blanks nor signs nor leading zeros
    code = F.when(number >= F.get(power, size - 1), number * F.get(power, DIGITS - size) * 100 + size)
    coded = logs.select(F.col("what_page").alias("id"), "access_time", code.alias("code"))
    combined = (coded.groupBy("id", F.when(F.col("code").isNull(), F.col("access_time")).alias("other"))
                .agg(F.max("code").alias("code")))
    digits = F.substring(F.lpad(F.expr("code div 100").cast("string"), DIGITS, "0"),
                         F.lit(1), F.pmod("code", F.lit(100)).cast("int"))
    return combined.groupBy("id").agg(F.max(F.coalesce("other", digits)).alias("latest"))


def latest_access(people: DataFrame, logs: DataFrame, threshold: int = LATEST_ACCESS_MIN,
                  order: str = "text", keep: str = "ge") -> DataFrame:
    """Q-G: (id, name) of pages whose latest access passes ``threshold``.

    ``order='text'`` takes the maximum of the access time as text (so "99999"
    beats "1000000") and only then reads it as int; ``order='numeric'`` takes
    the numeric maximum.  ``keep`` is ``'ge'`` (>= threshold) or ``'lt'``.
    """
    if order == "text":
        per_page = _latest_text(logs).select("id", text_to_int(F.col("latest")).alias("latest_date"))
    elif order == "numeric":
        per_page = logs.groupBy(F.col("what_page").alias("id")).agg(
            F.max(text_to_int(F.col("access_time"))).alias("latest_date"))
    else:
        raise ValueError("order must be 'text' or 'numeric'")
    if keep not in ("ge", "lt"):
        raise ValueError("keep must be 'ge' or 'lt'")
    cond = F.col("latest_date") >= threshold if keep == "ge" else F.col("latest_date") < threshold
    names = checked_broadcast(people.select("id", "name"))
    return per_page.where(cond).join(names, "id", "inner").select("id", "name")


def degree_summary(associates: DataFrame, deg: DataFrame | None = None) -> DataFrame:
    """Middle of Q-H: (total_relationships, num_owners, average_relationships)
    over the people with at least one relation."""
    if deg is None:
        deg = graph.degree(associates, count_name="relationship_count")
    # a bag COUNT skips the tuple whose first field (the id) is null
    return deg.agg(F.sum("relationship_count").cast("bigint").alias("total_relationships"),
                   F.count("id").cast("bigint").alias("num_owners"),
                   (F.sum("relationship_count").cast("double")
                    / F.count("id").cast("double")).alias("average_relationships"))


def above_average_degree(people: DataFrame, associates: DataFrame) -> DataFrame:
    """Q-H: (id, name, relationship_count) of people with more relations than
    the mean over people with at least one.  For integer counts
    ``n > floor(mean)`` equals ``n > mean``; the mean is a scalar subquery."""
    # the degree table feeds both the mean and the filter; the two plans differ
    # after filter pushdown, so Spark would not reuse the exchange and would
    # join and aggregate the relations twice: materialise it once instead
    ensure_checkpoint_dir(associates.sparkSession)
    deg = graph.degree(associates, count_name="relationship_count").checkpoint(eager=True)
    mean = degree_summary(associates, deg).select("average_relationships").scalar()
    popular = deg.where(F.col("relationship_count") > mean.cast("bigint"))
    return (popular.join(checked_broadcast(people.select("id", "name")), "id", "inner")
            .select("id", "name", "relationship_count"))
