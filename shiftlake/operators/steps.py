"""Process steps of a tube: tagging by device type and the cyclic successor."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import text_map

# The cycle of steps.
STEPS = ("LOAD", "CONDITION", "PROCESS", "CLEAN", "UNLOAD", "CHANGE")


@dataclass(frozen=True)
class StepRule:
    """Text of a device type that announces a step.

    ``kind``: ``same`` ignores case, ``exact`` does not, ``contains`` looks
    for the text anywhere.
    """

    eqp_type: str
    kind: str
    text: str
    step: str


# Texts in the order of STEPS.
_TEXTS = {
    "DF": ("process started", "Loading completed", "1st POCl3-deposition",
           "cool down + purge", "Unloading supervision", "recipe end"),
    "PE": ("process started", "Loading done", "Memory Text1 prepare deposition Layer 1",
           "Evacuate Tube and MFCs", "Fill tube with N2", "end of process"),
    "PR": ("process started", "Loading done", "prepare Alox deposition",
           "Evacuate Tube and MFCs", "Fill tube with N2", "end of process"),
    "TA": ("1.0", "3.0", "4.0", "6.0", "7.0", "8.0"),
}
_KINDS = {("PE", "CHANGE"): "contains", ("PR", "CHANGE"): "exact"}

STEP_RULES = tuple(
    StepRule(eqp_type, _KINDS.get((eqp_type, step), "same"), text, step)
    for eqp_type, texts in _TEXTS.items()
    for step, text in zip(STEPS, texts)
)


def tag_step(eqp_type: Column, text: Column, rules: tuple[StepRule, ...] = STEP_RULES) -> Column:
    """Step announced by ``text`` (already trimmed); null when no rule fits.

    Rules of kind ``same`` are one constant map; the others are tried after it
    in their order.
    """
    same: dict[str, str] = {}
    for rule in rules:
        if rule.kind == "same":
            same.setdefault(f"{rule.eqp_type}|{rule.text.lower()}", rule.step)
    out = F.try_element_at(text_map(same), F.concat_ws("|", eqp_type, F.lower(text)))
    for rule in rules:
        if rule.kind != "same":
            hit = text == rule.text if rule.kind == "exact" else text.contains(rule.text)
            out = F.coalesce(out, F.when((eqp_type == rule.eqp_type) & hit, F.lit(rule.step)))
    return out


def tag_steps(df: DataFrame, rules: DataFrame, eqp_type: str = "eqp_type", text: str = "_text", step: str = "step") -> DataFrame:
    """``df`` with the step that ``rules`` (``rule_no, eqp_type, kind, text, step``) give its trimmed text, null where none fits.

    The rules are those of ``tag_step``, but data: their number is not bounded
    by the plan. ``same`` and ``exact`` rules are joins on type and text, whose
    form Spark chooses by measured size; ``contains`` rules come as one list per
    type and are tried only where no rule of kind ``same`` fits. Of several
    rules for a text the smallest ``rule_no`` counts.
    """
    def least(rows: DataFrame, *keys: str) -> DataFrame:
        return rows.groupBy(*keys).agg(F.min(F.struct("rule_no", "step")).alias("_hit"))

    own = rules.select("rule_no", F.col("eqp_type").alias("_type"), "kind", F.col("text").alias("_rule"), F.col("step").alias("step"))
    same = least(own.where("kind = 'same'").withColumn("_rule", F.lower("_rule")), "_type", "_rule").withColumnsRenamed({"_hit": "_same", "_type": "_t1", "_rule": "_r1"})
    exact = least(own.where("kind = 'exact'"), "_type", "_rule").withColumnsRenamed({"_hit": "_exact", "_type": "_t2", "_rule": "_r2"})
    listed = own.where("kind = 'contains'").groupBy("_type").agg(
        F.collect_list(F.struct("rule_no", "step", "_rule")).alias("_listed")).withColumnRenamed("_type", "_t3")
    rows = df.join(same, (F.col(eqp_type) == F.col("_t1")) & (F.lower(text) == F.col("_r1")), "left")
    rows = rows.join(exact, (F.col(eqp_type) == F.col("_t2")) & (F.col(text) == F.col("_r2")), "left")
    rows = rows.join(listed, F.col(eqp_type) == F.col("_t3"), "left")
    inside = F.array_min(F.transform(F.filter("_listed", lambda r: F.contains(F.col(text), r["_rule"])),
                                     lambda r: F.struct(r["rule_no"].alias("rule_no"), r["step"].alias("step"))))
    found = F.when(F.col("_same").isNotNull(), F.col("_same.step")).otherwise(F.least(F.col("_exact"), inside)["step"])
    return rows.select(*[c for c in df.columns if c != step], found.alias(step))


def next_step(step: Column) -> Column:
    return F.try_element_at(text_map(dict(zip(STEPS, STEPS[1:] + STEPS[:1]))), step)
