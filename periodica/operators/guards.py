"""Proof guards on extracted records. records: publisher, document, position, issue, value, snippet, kind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as T
from .extract import page_text

LABELLED = f"(?:{fixed.LABEL})((?:(?!{fixed.LABEL}).){{0,{fixed.LABEL_REACH}}})"
NUMBER = r"(?s)^(.*?)(?<!\d)(\d{1,4})(?!\d)(.*)$"  # what stands before the first number, it, and what stands behind


def evidence(records: DataFrame, documents: DataFrame) -> DataFrame:
    """Records with evidence: the snippet and the document's chunks of the issue, where not in it
    already. The chunks are put together once for each document and issue, not for each record."""
    text = documents.select("document", page_text(F.col("content")).alias("text"))
    chunks = text.select("document", F.posexplode(T.issue_chunks(F.col("text"))).alias("n", "chunk")).withColumn("issue", T.leading_issue(F.col("chunk")))
    joined = chunks.where("issue IS NOT NULL").groupBy("document", "issue").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "chunk"))), lambda x: x["chunk"]), " ").alias("proof")
    )
    plain = T.normalize("snippet")
    whole = F.when((plain != "") & (F.col("proof") != "") & ~F.contains(plain, F.col("proof")), F.concat_ws(" ", plain, "proof"))
    return records.join(joined, ["document", "issue"], "left").withColumn(
        "evidence", F.coalesce(whole, F.when(plain != "", plain), F.col("proof"), F.lit(""))
    ).drop("proof")


def bare(text: Column) -> Column:
    """What P2 to P4 look at: the text without issue numbers and before the first draw marker."""
    return T.prediction_part(T.normalize(F.regexp_replace(text, r"(?<!\d)\d{1,4}\s*期", " ")))


def captured(text: Column, patterns) -> Column:
    return F.concat(*[F.regexp_extract_all(text, F.lit("(?s)" + p), F.lit(1)) for p in patterns])


def ambiguous(plain: Column) -> Column:
    """P2, of `bare` text: a pattern captures a number of different digits."""
    return F.exists(captured(plain, (*fixed.VALUE_PATTERNS, *fixed.BRACKETED)), lambda v: T.exact_digit(v).isNull())


def verdicts(plain: Column) -> Column:
    """P3, of `bare` text: of each bracketed value, and of the stretch behind each label as far as the next one: the digit that
    it proves, or what speaks against it. A stretch without a number says nothing. Between a label and its
    number only decoration may stand; the number has to be one digit (or one repeated) and the only one."""
    digit = lambda raw: F.coalesce(T.exact_digit(raw).cast("string"), F.lit("several digits"))

    def behind(stretch: Column) -> Column:
        before, raw, after = (F.regexp_extract(stretch, NUMBER, i) for i in (1, 2, 3))
        return (
            F.when(raw == "", F.lit(None).cast("string"))
            .when(F.regexp_replace(before, fixed.ALLOWED_INFIX, "").rlike(fixed.FOREIGN), "other words between")
            .when(T.exact_digit(raw).isNotNull() & after.rlike("^" + fixed.FURTHER_VALUE), "several values")
            .otherwise(digit(raw))
        )

    stretches = F.regexp_extract_all(plain, F.lit("(?s)" + LABELLED), F.lit(1))
    return F.array_compact(F.concat(F.transform(captured(plain, fixed.BRACKETED), digit), F.transform(stretches, behind)))


def adjacent(text: Column, value: Column) -> Column:
    """Struct of proven (the value stands next to a label) and fault (the first thing against one)."""
    return near(verdicts(bare(text)), value)


def near(found: Column, value: Column) -> Column:
    fault = F.try_element_at(F.filter(found, lambda v: F.length(v) > 1), F.lit(1))
    return F.struct(F.coalesce(F.array_contains(found, value), F.lit(False)).alias("proven"), fault.alias("fault"))


def strict(plain: Column, value: Column) -> Column:
    """P4, of `bare` text: a strict pattern captures exactly the value."""
    return F.array_contains(captured(plain, fixed.STRICT), value)


def enforce(records: DataFrame, documents: DataFrame, exact: Column | None = None) -> DataFrame:
    """P5: adds error (null if proven) and document_error, the document's first one: a violation fails the
    document. Pairs, categories and table records pass; a user feed only needs P2; section, compact
    and lead_compact need P3 or P4; dedicated ones fail by any fault of P3, or unproven beside a
    label, unless `exact` says that their own form is proof."""
    plain = evidence(records, documents).withColumn("plain", bare(F.col("evidence")))  # once for all guards
    proven = plain.withColumn("found", verdicts(F.col("plain"))).withColumn("near", near(F.col("found"), F.col("value")))
    single = F.col("value").rlike(r"^\d$") & (F.col("kind") != "table")
    strict_kind = F.col("kind").isin("section", "compact", "lead_compact")
    dedicated = (F.col("kind") == "dedicated") & ~(F.lit(False) if exact is None else exact)
    error = F.when(
        single,
        F.when(ambiguous(F.col("plain")), "several digits")
        .when(strict_kind & ~F.col("near.proven") & ~strict(F.col("plain"), F.col("value")), "not adjacent")
        .when(dedicated & F.col("near.fault").isNotNull(), F.col("near.fault"))
        .when(dedicated & ~F.col("near.proven") & F.col("plain").rlike(f"{fixed.LABEL}|{fixed.BRACKETED[0]}"), "not proven"),
    )
    judged = proven.withColumn("error", error).drop("plain", "found", "near")
    worst = judged.groupBy("document").agg(F.min_by("error", F.when(F.col("error").isNotNull(), F.col("position"))).alias("document_error"))
    return judged.join(worst, "document")
