"""What a marketplace reports about our listings, folded into their states; and change records of observed items."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

# Messages of failed registrations, after which the listing is taken to be gone, or to be stopped already.
GONE_MESSAGES = ("商品IDは不正な値です", "削除できない商品です")
STOPPED_MESSAGE = "商品管理番号は不正な値です"
#: Kinds of events, and in which phases of a listing each may come. Phases: none, live, stopped, gone.
LEGAL = {
    "registered": ("none", "live", "stopped", "gone"),
    "updated": ("live", "stopped"),
    "stopped": ("live", "stopped"),
    "deleted": ("live", "stopped"),
    "reset": ("none", "live", "stopped", "gone"),
    "found stopped": ("none", "live", "stopped"),
    "not created": ("none", "stopped", "gone"),
    "not updated": ("live", "stopped"),
}
#: What a kind sets: phase, status, published, locked (None leaves it), and whether the product's id is taken or cleared.
EFFECTS = {
    "registered": ("live", "success", 1, 1, "take"),
    "updated": ("live", "success", 1, 1, "take"),
    "stopped": ("stopped", "soldout", 0, None, None),
    "deleted": ("gone", "deleted", 0, None, None),
    "reset": ("none", "fail", 0, 0, "clear"),
    "found stopped": ("stopped", "soldout", 0, None, None),
    "not created": (None, "fail", None, None, None),
    "not updated": (None, "fail", None, None, None),
}
STATE = "phase string, status string, published int, locked int, product_id long, registered_at long, n_applied long, n_illegal long"


def event_kind(event: Column, status: Column, product_id: Column, message: Column) -> Column:
    """The kind of an event by its name, the status in it, and the message of a failure; null for what means nothing."""
    made, changed = event == "product/create", event == "product/update"
    told = F.coalesce(message, F.lit(""))
    gone = told.contains(GONE_MESSAGES[0]) | told.contains(GONE_MESSAGES[1])
    return (
        F.when((made | changed) & (status == "buyer_deleted"), "deleted")
        .when((made | changed) & (status == "buyer_suspended"), "stopped")
        .when(made & product_id.isNotNull(), "registered")
        .when(changed & product_id.isNotNull(), "updated")
        .when((event == "product/fail_to_create") & gone, "reset")
        .when((event == "product/fail_to_create") & told.contains(STOPPED_MESSAGE), "found stopped")
        .when(event == "product/fail_to_create", "not created")
        .when(event == "product/fail_to_update", "not updated")
    )


def parsed_events(raw: DataFrame, body: str = "body") -> DataFrame:
    """reference, at, seq, kind, product_id of events with their JSON text; the reference stands at the top or in ``product``.

    Texts that are no JSON, and events without reference or meaning, give no row.
    """
    top = "reference_number string, id long, status string, errors string, product struct<reference_number:string,id:long>"
    read = raw.withColumn("b", F.from_json(body, top))
    reference = F.coalesce(F.nullif(F.col("b.reference_number"), F.lit("")), F.col("b.product.reference_number"))
    number = F.coalesce("b.id", "b.product.id")
    kind = event_kind(F.col("event"), F.coalesce("b.status", F.lit("")), number, F.col("b.errors"))
    return read.select(reference.alias("reference"), "at", "seq", kind.alias("kind"), number.alias("product_id")).filter("reference IS NOT NULL AND kind IS NOT NULL")


def _table(rows: dict[str, object], key: Column) -> Column:
    return F.element_at(F.create_map(*(x for k, v in rows.items() for x in (F.lit(k), v))), key)


def folded(events: DataFrame) -> DataFrame:
    """reference and its state (``STATE``) after its events in order of at and seq.

    A kind that may not come in the listing's phase is counted in n_illegal and changes nothing. registered_at is the
    time, in microseconds, when the listing first went live. One listing's events are folded as an array, in the JVM.
    """
    lists = events.groupBy("reference").agg(F.array_sort(F.collect_list(_event())).alias("events"))
    return lists.select("reference", _fold(F.col("events")).alias("s")).select("reference", "s.*")


def _event() -> Column:
    return F.struct(F.unix_micros(F.col("at").cast("timestamp")).alias("at"), "seq", "kind", "product_id")


def _fold(events: Column) -> Column:
    """The state (``STATE``) after a sorted array of events."""
    legal = {k: F.array(*map(F.lit, v)) for k, v in LEGAL.items()}
    text = lambda x: F.lit(x).cast("string")
    whole = lambda x: F.lit(x).cast("int")
    effect = {k: F.struct(text(p).alias("phase"), text(s).alias("status"), whole(a).alias("published"), whole(b).alias("locked"), text(i).alias("id")) for k, (p, s, a, b, i) in EFFECTS.items()}
    typed = lambda v, t, n: F.lit(v).cast(t).alias(n)
    start = F.struct(*(typed("none" if n == "phase" else 0 if n in ("n_applied", "n_illegal", "published", "locked") else None, t, n) for n, t in (f.strip().split(" ") for f in STATE.split(","))))

    def step(s: Column, e: Column) -> Column:
        x = e["sets"]
        after = F.struct(
            F.coalesce(x["phase"], s["phase"]).alias("phase"),
            x["status"].alias("status"),
            F.coalesce(x["published"], s["published"]).alias("published"),
            F.coalesce(x["locked"], s["locked"]).alias("locked"),
            F.when(x["id"] == "take", e["product_id"]).when(x["id"] == "clear", F.lit(None)).otherwise(s["product_id"]).alias("product_id"),
            F.coalesce(s["registered_at"], F.when(x["id"] == "take", e["at"])).alias("registered_at"),
            (s["n_applied"] + 1).alias("n_applied"),
            s["n_illegal"].alias("n_illegal"),
        )
        refused = F.struct(*(s[f].alias(f) for f in ("phase", "status", "published", "locked", "product_id", "registered_at", "n_applied")), (s["n_illegal"] + 1).alias("n_illegal"))
        return F.when(F.array_contains(e["legal"], s["phase"]), after).otherwise(refused)

    # The tables are looked up once an event; in a step it would be once for each name of what they give.
    found = lambda e: F.struct(e["at"].alias("at"), e["product_id"].alias("product_id"), _table(effect, e["kind"]).alias("sets"), _table(legal, e["kind"]).alias("legal"))
    return F.aggregate(F.transform(events, found), start, step)


#: The table of ``folded_step``: a reference's events so far, in order, and its state after them.
FOLDED = f"reference string, events array<struct<at:long,seq:long,kind:string,product_id:long>>, s struct<{STATE.replace(' ', ':').replace(',:', ',')}>"


def folded_step(batch: DataFrame, known: DataFrame | None) -> DataFrame:
    """The table ``FOLDED`` after a batch of events; those of a reference that the batch has are folded anew, in the JVM.

    Events may come late and in any order, so all events of a reference stay in the table.
    """
    none = F.lit(None).cast(T.StructType.fromDDL(FOLDED)["s"].dataType)
    lists = batch.groupBy("reference").agg(F.collect_list(_event()).alias("events")).select("reference", "events", none.alias("s"), F.lit(True).alias("new"))
    if known is not None:
        lists = lists.unionByName(known.withColumn("new", F.lit(False)))
    whole = lists.groupBy("reference").agg(F.array_sort(F.flatten(F.collect_list("events"))).alias("events"), F.max("s").alias("s"), F.max("new").alias("new"))
    return whole.select("reference", "events", F.when(F.col("new"), _fold(F.col("events"))).otherwise(F.col("s")).alias("s"))


def apply_event(state: dict, at: int, kind: str, product_id: int | None) -> dict:
    """One step of ``folded`` in plain Python, for streams."""
    if state["phase"] not in LEGAL[kind]:
        return state | {"n_illegal": state["n_illegal"] + 1}
    phase, status, published, locked, number = EFFECTS[kind]
    out = state | {"phase": phase or state["phase"], "status": status, "n_applied": state["n_applied"] + 1}
    out |= {k: v for k, v in (("published", published), ("locked", locked)) if v is not None}
    if number:
        out["product_id"] = product_id if number == "take" else None
    if number == "take" and out["registered_at"] is None:
        out["registered_at"] = at
    return out


def folded_stream(events: DataFrame) -> DataFrame:
    """``folded`` as a stream: for each batch the states of its references, after all of their events so far by time.

    Events may come late and in any order, so a reference's events stay in its state, as many as it has.
    """
    start = {"phase": "none", "status": None, "published": 0, "locked": 0, "product_id": None, "registered_at": None, "n_applied": 0, "n_illegal": 0}

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = [tuple(e) for e in json.loads(state.get[0])] if state.exists else []
        for b in batches:
            held += [(int(a), int(n), k, None if pd.isna(i) else int(i)) for a, n, k, i in zip(b["us"], b["seq"], b["kind"], b["product_id"], strict=True)]
        held.sort(key=lambda e: e[:2])
        state.update((json.dumps(held),))
        now = start
        for at, _, kind, number in held:
            now = apply_event(now, at, kind, number)
        out = pd.DataFrame([{"reference": key[0], **now}])
        yield out.astype({c: "Int64" for c in ("product_id", "registered_at")})

    rows = events.select("reference", F.unix_micros(F.col("at").cast("timestamp")).alias("us"), "seq", "kind", "product_id")
    return rows.groupBy("reference").applyInPandasWithState(step, f"reference string, {STATE}", "events string", "update", GroupStateTimeout.NoTimeout)
