"""Why and since when a contact may not be mailed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contactloom import fixed_values as V
from contactloom.functions.email import blocked_domain, invalid_email
from contactloom.functions.scalar import column, glue, never_when

Rules = Sequence[tuple[Column, Column | str]]


def suppression_reason(rules: Rules) -> Column:
    """First rule whose condition is true names the reason; NULL conditions fall through."""
    out = F
    for cond, reason in rules:
        out = out.when(cond, reason)
    return out.otherwise(V.EMAILABLE)


def opt_out_label(product: Column | str) -> Column:
    return glue(product, F.lit(V.OPT_OUT_SUFFIX), null_as_empty=True)


def professional_rules() -> Rules:
    """The order matters: status, record state, AMA, type, address, domain, merge, held, opt-out."""
    source = F.col("hcp_source")
    listed, mailed = source == "NBA HCP", source == "SFMC HCP"
    return [
        (F.col("hcp_status") != "Active", V.STATUS_INACTIVE),
        (F.col("record_state_cd") != "ACTIVE", V.STATE_INACTIVE),
        (F.col("ama_opt_out_flag") == "Y", V.AMA_OPT_OUT),
        (~F.col("hcp_type").isin(V.PRESCRIBER_TYPES), V.NON_PRESCRIBERS),
        (listed & invalid_email("nba_email_address"), V.BAD_EMAIL),
        (mailed & invalid_email("party_email_address"), V.BAD_EMAIL),
        (listed & blocked_domain("nba_email_address"), V.BLOCKED),
        ((source != "NBA HCP") & blocked_domain("party_email_address"), V.BLOCKED),
        (F.col("et_active") == "N", V.MERGED),
        (F.col("bounce_flag") == 1, V.HELD),
        (F.col("opt_out_flag") == "Y", opt_out_label("product_name")),
    ]


def patient_rules() -> Rules:
    """Like the professional list, but opt-out comes before held."""
    return [
        (F.col("record_state") != "A", V.STATE_INACTIVE),
        (F.col("feed_origin") != "PAT", V.FEED_ORIGIN),
        (F.col("party_type") != "PAT", V.PARTY_TYPE),
        (~F.col("patient_class").isin(V.PATIENT_CLASSES), V.PATIENT_CLASS),
        (F.col("suppressed_code") != "N", V.SUPPRESSED),
        (invalid_email("primary_email"), V.BAD_EMAIL),
        ((F.col("age") < 18) | F.col("pat_segment").isin(V.MINOR_SEGMENTS), V.INVALID_AGE),
        (blocked_domain("primary_email"), V.BLOCKED),
        (F.col("et_active") == "N", V.MERGED),
        (F.col("opt_out_flag") == "Y", opt_out_label("product_name")),
        (F.col("bounce_flag") == 1, V.HELD),
    ]


def party_date(reason: Column | str, party_reasons: Sequence[str], created: Column | str) -> Column:
    """Creation date for reasons that lie in the party record, 'never' for all others."""
    return never_when(~column(reason).isin(list(party_reasons)), created, V.NEVER)


def cause_date(day: Column | str, flag_off: Column) -> Column:
    """'Never' when there is no date or the flag is off; an unknown flag leaves the date."""
    return never_when(column(day).isNull() | flag_off, day, V.NEVER)


# (date column, condition, reason, source label); the order decides nothing but readability,
# since at most one date can be strictly earlier than the three others.
def _causes():
    return [
        ("party_suppression_date", F.lit(True), F.col("tmp_suppression_criteria"), None),
        ("opt_out_date", F.col("opt_out_flag") == "Y", opt_out_label("product_name"), V.SOURCE_OPT),
        ("merge_record_date", F.col("et_active") == "N", F.lit(V.MERGED), V.SOURCE_MERGE),
        ("bounce_date", F.col("bounce_flag") == 1, F.lit(V.HELD), V.SOURCE_BOUNCE),
    ]


def earliest_cause(df: DataFrame) -> DataFrame:
    """Add suppression date, criteria and source from the one cause that precedes all others.

    Ties, and rows where every date is 'never', take the source date, the interim reason, and
    the party table as source unless the record is emailable."""
    causes = _causes()
    day, reason, origin = F, F, F
    for name, active, label, source in causes:
        first = active
        for other, *_ in causes:
            if other != name:
                first = first & (F.col(name) < F.col(other))
        day, reason = day.when(first, F.col(name)), reason.when(first, label)
        if source:
            origin = origin.when(first, source)
    interim = F.col("tmp_suppression_criteria")
    undated = F.lit(True)
    for name, *_ in causes:
        undated = undated & F.col(name).isNull()
    return df.withColumns({
        "suppression_date": day.otherwise(F.col("source_dt").cast("timestamp")),
        "suppression_criteria": reason.when(undated, V.EMAILABLE).otherwise(interim),
        "suppression_source": origin.when(interim != V.EMAILABLE, V.SOURCE_PARTY)
        .otherwise(V.SOURCE_NONE),
    })


def clamp_dates(df: DataFrame, clamped_reasons: Sequence[str]) -> DataFrame:
    """Final dates: some reasons hold since the source date, and a source date never lies after
    the suppression date."""
    source, since = F.col("source_dt").cast("timestamp"), F.col("suppression_date")
    early = F.col("suppression_criteria").isin(list(clamped_reasons)) & (source < since)
    return df.withColumns({
        "final_suppression_date": F.when(early, source).otherwise(since),
        "final_source_dt": F.when(source > since, since).otherwise(source),
    })
