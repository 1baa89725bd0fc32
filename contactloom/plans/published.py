"""The workflows' results and the layered mail products as named tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from contactloom.functions.scalar import day_from_digits, whole_number
from contactloom.operators.rejects import split_rejects
from contactloom.plans.activity import activity_by_month
from contactloom.plans.email_engagement import email_base, email_engagement
from contactloom.plans.field import non_promotional_metrics, promotional_metrics, target_list
from contactloom.plans.interactions import interactions, universe
from contactloom.plans.patient import patient_workflow
from contactloom.plans.professional import professional_workflow
from contactloom.plans.ranking import professional_ranking
from contactloom.sources.contracts import EMAIL_BASE, EMAIL_FUNNEL, INTERACTION, METRIC, REP_METRIC, TARGETED, UNIVERSE
from contactloom.sources.products import publish, publish_layers
from contactloom.sources.tables import Tables

CONTRACTS = {"target_list": TARGETED, "interactions": INTERACTION, "universe": UNIVERSE, "email_base": EMAIL_BASE,
             "email_engagement": EMAIL_FUNNEL, "non_promotional_metrics": METRIC, "promotional_metrics": REP_METRIC}


def publish_professional(spark: SparkSession, t: Tables, prefix: str) -> dict[str, DataFrame]:
    """The five tables of the professional workflow, shown together when all are written."""
    return publish(spark, lambda: professional_workflow(t), prefix)


def publish_patient(spark: SparkSession, t: Tables, as_of: date, prefix: str) -> dict[str, DataFrame]:
    """The five tables of the patient workflow, shown together when all are written."""
    return publish(spark, lambda: patient_workflow(t, as_of), prefix)


def publish_mail(spark: SparkSession, t: Tables, as_of: date, prefix: str) -> dict[str, DataFrame]:
    """Activity in monthly partitions, ranking, mail base and mail funnel, each made from the stored ones before."""
    return publish_layers(t, {
        "activity": activity_by_month,
        "target_list": target_list,
        "ranking": lambda s: professional_ranking(s, s["target_list"], as_of),
        "email_base": lambda s: email_base(s, s["ranking"], s["activity"]),
        "email_engagement": lambda s: email_engagement(s["email_base"]),
    }, prefix, spark, CONTRACTS, {"activity": "activity_month"})


def publish_field(spark: SparkSession, t: Tables, as_of: date, prefix: str) -> dict[str, DataFrame]:
    """Target list, interactions, universe and both metric tables."""
    return publish_layers(t, {
        "target_list": target_list, "interactions": interactions,
        "universe": lambda s: universe(s, s["interactions"], s["target_list"]),
        "non_promotional_metrics": lambda s: non_promotional_metrics(s, as_of),
        "promotional_metrics": lambda s: promotional_metrics(s, as_of),
    }, prefix, spark, CONTRACTS)


def parsed_sources(t: Tables) -> tuple[Tables, dict[str, DataFrame]]:
    """The tables with dirty rows taken out of those whose text keys and days the workflows parse, and the rows taken
    out by table.  The plans read the former as they read the tables."""
    rules = {"first_source": {"party_fk": whole_number("party_fk")}, "attendee": {"created_date": day_from_digits("created_date")},
             "event": {"event_start_date_time": day_from_digits("event_start_date_time")}}
    clean, rejected = {}, {}
    for name, parse in rules.items():
        clean[name], rejected[name] = split_rejects(t[name], parse)
    return t.with_results(**clean), rejected
