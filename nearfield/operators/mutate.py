"""Ordered business mutations applied as one batch.

A mutation table holds ordered CREATE / UPDATE / DELETE requests. Per business id the service's
rules give a closed form, so the batch needs no row-by-row loop:

* a CREATE or UPDATE whose payload breaks the payload rules is rejected with them and changes nothing;
* an id is *alive* from the start if its current row is ACTIVE, or from its CREATE (which
  must name an id that does not exist yet);
* UPDATE and DELETE are accepted while the id is alive, i.e. after it became alive and up to
  and including its first DELETE; everything else is rejected NOT_FOUND;
* the final row is the last accepted CREATE/UPDATE payload (or the current row), with status
  DELETED and the delete time when the last accepted mutation is a DELETE.

All per-id facts come from grouped aggregations (partial aggregation, fixed-size state per id)
joined back on business_id, never from a window that would buffer a busy id in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearfield.functions import geo
from nearfield.operators.load import assign_ids
from nearfield.operators.validate import business_reasons

CHANGE_TYPE = {"CREATE": "CREATED", "UPDATE": "UPDATED", "DELETE": "DELETED"}
PAYLOAD = ["owner_id", "name", "category", "phone", "address", "latitude", "longitude"]


def decide(business: DataFrame, mutations: DataFrame) -> DataFrame:
    """Mutations with ``accepted`` and ``reason`` (the payload rules broken, NOT_FOUND or ALREADY_EXISTS) columns. Rules of
    payload columns that the mutation table does not have are not asked."""
    bad = F.when(F.col("op") != "DELETE", business_reasons([c for c in PAYLOAD if c in mutations.columns]))
    mutations = mutations.withColumn("bad_payload", bad)
    cur = business.select(F.col("id").alias("business_id"), F.col("status").alias("cur_status"))
    m = mutations.join(cur, "business_id", "left")
    creates = (m.filter((F.col("op") == "CREATE") & F.col("cur_status").isNull() & F.col("bad_payload").isNull())
               .groupBy("business_id").agg(F.min("mutation_id").alias("create_at")))
    m = m.join(creates, "business_id", "left")
    alive_from = F.when(F.col("cur_status") == "ACTIVE", F.lit(-1).cast("long")).otherwise(F.col("create_at"))
    m = m.withColumn("alive_from", alive_from)
    deletes = (m.filter((F.col("op") == "DELETE") & (F.col("mutation_id") > F.col("alive_from")))
               .groupBy("business_id").agg(F.min("mutation_id").alias("delete_at")))
    m = m.join(deletes, "business_id", "left")
    is_create = (F.col("op") == "CREATE") & F.col("cur_status").isNull() & (F.col("mutation_id") == F.col("create_at"))
    alive = (F.col("alive_from").isNotNull() & (F.col("mutation_id") > F.col("alive_from"))
             & (F.col("delete_at").isNull() | (F.col("mutation_id") <= F.col("delete_at"))))
    accepted = F.col("bad_payload").isNull() & (is_create | (F.col("op").isin("UPDATE", "DELETE") & alive))
    reason = (F.when(accepted, F.lit(None).cast("string"))
              .when(F.col("bad_payload").isNotNull(), F.col("bad_payload"))
              .when(F.col("op") == "CREATE", F.lit("ALREADY_EXISTS"))
              .otherwise(F.lit("NOT_FOUND")))
    return m.withColumn("accepted", F.coalesce(accepted, F.lit(False))).withColumn("reason", reason)


def apply_mutations(business: DataFrame, mutations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Returns (new business snapshot with geohash, accepted decisions, rejects).

    An UPDATE replaces the whole payload, nulls included; payload columns that the mutation table does not have keep the
    current value (null on create).
    """
    given = {c for c in PAYLOAD if c in mutations.columns}
    d = decide(business, mutations)
    for c in PAYLOAD:
        if c not in given:
            d = d.withColumn(c, F.lit(None))
    acc = d.filter(F.col("accepted"))
    write_key = F.when(F.col("op") != "DELETE", F.col("mutation_id"))
    payload = F.struct(*[F.col(c).alias(c) for c in PAYLOAD], F.col("requested_at").alias("requested_at"))
    final = acc.groupBy("business_id").agg(
        F.max_by(payload, write_key).alias("w"),
        F.max_by(F.col("op"), F.col("mutation_id")).alias("last_op"),
        F.max_by(F.col("requested_at"), F.col("mutation_id")).alias("last_at"),
        F.max_by(F.col("requested_at"), F.when(F.col("op") == "CREATE", F.col("mutation_id"))).alias("created_req"),
    )
    cur_cols = ["id", *PAYLOAD, "status", "created_at", "updated_at"]
    cur = business.select(*[F.col(c).alias(f"c_{c}") for c in cur_cols])
    j = final.join(cur, final["business_id"] == cur["c_id"], "left")
    has_write = F.col("w").isNotNull()
    changed = j.select(
        F.col("business_id").alias("id"),
        *[(F.when(has_write, F.col(f"w.{c}")).otherwise(F.col(f"c_{c}")) if c in given else F.col(f"c_{c}")).alias(c) for c in PAYLOAD],
        F.when(F.col("last_op") == "DELETE", F.lit("DELETED")).otherwise(F.lit("ACTIVE")).alias("status"),
        F.coalesce(F.col("c_created_at"), F.col("created_req")).alias("created_at"),
        F.col("last_at").alias("updated_at"),
    )
    untouched = business.join(final.select(F.col("business_id").alias("id")), "id", "left_anti").select(
        "id", *PAYLOAD, "status", "created_at", "updated_at")
    snapshot = untouched.unionByName(changed)
    snapshot = geo.with_geohash(snapshot.withColumn("_glat", F.round("latitude", 6)).withColumn("_glon", F.round("longitude", 6)),
                                "_glat", "_glon", 8, "geohash").drop("_glat", "_glon")
    rejects = d.filter(~F.col("accepted")).select("mutation_id", "business_id", "op", "reason")
    return snapshot, acc, rejects


def mutation_log(accepted: DataFrame, change_log: DataFrame) -> DataFrame:
    """One change event per accepted mutation, ids continuing the change log, in mutation order."""
    ev = accepted.select(
        "mutation_id", "business_id",
        F.when(F.col("op") == "CREATE", F.lit(CHANGE_TYPE["CREATE"]))
         .when(F.col("op") == "UPDATE", F.lit(CHANGE_TYPE["UPDATE"]))
         .otherwise(F.lit(CHANGE_TYPE["DELETE"])).alias("change_type"),
        F.lit(False).alias("processed"),
        F.col("requested_at").alias("created_at"),
    )
    ided = assign_ids(ev, change_log, "mutation_id", "id", "id")
    return ided.select("id", "business_id", "change_type", "processed", "created_at", "mutation_id")
