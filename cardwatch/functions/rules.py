"""Rule-based explanation of a transaction, as column expressions.

Each rule is a predicate over request/silver columns and a reason text. A NULL input means
"the rule does not fire" (requests never carry NULLs; left-join misses in tables do).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The seven rules, in their order, and their reason texts (French, verbatim).
REASON_HIGH_AMOUNT = "Montant élevé"
REASON_LOW_CREDIT = "Score de crédit faible"
REASON_UNUSUAL_PLACE = "Localisation inhabituelle"
REASON_NO_CHIP = "Transaction sans puce"
REASON_MANY_CARDS_ISSUED = "Beaucoup de cartes émises"
REASON_TOO_MANY_CARDS = "Trop de cartes de crédit"
REASON_UNKNOWN_GENDER = "Genre non identifié"
NO_REASON = "Aucune anomalie détectée dans les règles simples."
AMOUNT_LIMIT = 2000
CREDIT_SCORE_FLOOR = 400
LATITUDE_BAND = (35, 50)
CARDS_ISSUED_LIMIT = 5
CREDIT_CARDS_LIMIT = 8
KNOWN_GENDERS = ("male", "female")

# The probability and decision of the rule scorer are ours: share of rules fired, fraud from 3.
RULE_COUNT = 7
RULE_FRAUD_FROM = 3


def rule_sql() -> list[tuple[str, str]]:
    """(SQL predicate, reason) per rule, in rule order."""
    lo, hi = LATITUDE_BAND
    genders = ", ".join(f"'{g}'" for g in KNOWN_GENDERS)
    return [
        (f"amount > {AMOUNT_LIMIT}", REASON_HIGH_AMOUNT),
        (f"credit_score < {CREDIT_SCORE_FLOOR}", REASON_LOW_CREDIT),
        (f"(latitude > {hi} OR latitude < {lo})", REASON_UNUSUAL_PLACE),
        ("lower(use_chip) = 'no'", REASON_NO_CHIP),
        (f"num_cards_issued > {CARDS_ISSUED_LIMIT}", REASON_MANY_CARDS_ISSUED),
        (f"num_credit_cards > {CREDIT_CARDS_LIMIT}", REASON_TOO_MANY_CARDS),
        (f"NOT (lower(gender) IN ({genders}))", REASON_UNKNOWN_GENDER),
    ]


def _text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def rule_predicates() -> list[tuple[Column, str]]:
    return [(F.expr(p), text) for p, text in rule_sql()]


def rules_fired() -> Column:
    """Number of rules that fire (int); a rule whose input is NULL does not fire."""
    return F.expr(" + ".join(f"CASE WHEN {p} THEN 1 ELSE 0 END" for p, _ in rule_sql()))


def reasons() -> Column:
    """array<string> of reasons in rule order; the default text when none fires."""
    candidates = ", ".join(f"CASE WHEN {p} THEN {_text(t)} END" for p, t in rule_sql())
    kept = f"filter(array({candidates}), x -> x IS NOT NULL)"
    return F.expr(f"CASE WHEN size({kept}) = 0 THEN array({_text(NO_REASON)}) ELSE {kept} END")


def rule_probability(k: Column | None = None) -> Column:
    """Share of rules fired; pass an already computed count column to avoid re-evaluating the rules."""
    return (rules_fired() if k is None else k) / F.lit(float(RULE_COUNT))


def rule_decision(k: Column | None = None) -> Column:
    return F.when((rules_fired() if k is None else k) >= RULE_FRAUD_FROM, F.lit(1.0)).otherwise(F.lit(0.0))
