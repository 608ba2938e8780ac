"""Offers as column expressions: from free text, and the rule for the sort column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerledger.functions import text as T


def effective_value(value: Column, kind: Column, label: Column, new_customer_only: Column) -> Column:
    """The sort column: purchase offers without a category, for everybody.  Compare within a unit only."""
    return F.when((kind == "purchase") & label.isNull() & ~F.coalesce(new_customer_only, F.lit(False)), value)


def offer_from_text(raw: Column, current: Column | None = None, base: Column | None = None, label: Column | None = None, conditions: Column | None = None) -> Column:
    """struct of an offer read in a free text; null where no amount is found.

    current and base are fragments of a page that tell the rate in force from the one struck through.
    Without current, the first amount counts; if the first two share a unit, the larger is in force
    and the smaller the base.
    """
    none = F.lit(None).cast("string")
    current, base, label, conditions = (none if c is None else c for c in (current, base, label, conditions))
    filled = lambda c: F.nullif(c, F.lit(""))
    context = F.concat_ws(" ", filled(raw), filled(label), filled(conditions))
    words = T.hits(T.fold(context), T.UP_TO, T.SIGN_UP, T.GIFT_CARD, T.NEW_CUSTOMER, T.SALE_EXCLUDED, T.MARKETPLACE_EXCLUDED)
    texts = {"raw": raw, "current": current, "base": base, "label": label, "conditions": conditions}
    facts = F.struct(*(c.alias(n) for n, c in texts.items()), words.alias("words"), T.extract_amounts(current).alias("told"), T.extract_amounts(raw).alias("read"), T.extract_amounts(base).alias("under"))
    return T.once(facts, lambda f: T.once(_rate(f), lambda r: F.when(r["value"].isNotNull(), _offer(f, r))))


def _rate(f: Column) -> Column:
    """struct(value, base, unit) of a text's facts."""
    at = lambda amounts, i: F.try_element_at(f[amounts], F.lit(i))
    first, second, given = at("read", 1), at("read", 2), f["current"].isNotNull()
    boosted = first["unit"] == second["unit"]
    value = F.when(given, at("told", 1)["value"]).when(boosted, F.greatest(first["value"], second["value"])).otherwise(first["value"])
    base = F.when(given, at("under", 1)["value"]).when(boosted, F.least(first["value"], second["value"]))
    return F.struct(value.alias("value"), base.alias("base"), F.when(given, at("told", 1)["unit"]).otherwise(first["unit"]).alias("unit"))


def _offer(f: Column, r: Column) -> Column:
    has = lambda words: T.any_of(f["words"], words)
    kind = F.when(F.coalesce(f["label"], F.lit("")) != "", "category").when(has(T.SIGN_UP), "signup_bonus").when(has(T.GIFT_CARD), "giftcard").otherwise("purchase")
    new_only = has(T.NEW_CUSTOMER)
    return F.struct(
        F.trim(f["raw"]).alias("raw_text"),
        r["value"].alias("value"),
        r["base"].alias("value_base"),
        r["unit"].alias("unit"),
        kind.alias("kind"),
        f["label"].alias("category_label"),
        f["conditions"].alias("conditions_text"),
        has(T.UP_TO).alias("is_upto"),
        new_only.alias("is_new_customer_only"),
        T.true_or_null(has(T.SALE_EXCLUDED)).alias("is_sale_excluded"),
        T.true_or_null(has(T.MARKETPLACE_EXCLUDED)).alias("is_marketplace_excluded"),
        effective_value(r["value"], kind, f["label"], new_only).alias("effective_value"),
    )
