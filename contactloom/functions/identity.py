"""Customer keys and classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from contactloom import fixed_values as V
from contactloom.functions.scalar import column


def resolve_identity(account: Column | str, person: Column | str, raw: Column | str,
                     prefix: bool = True) -> Column:
    """One key for a customer: the raw channel identity when neither id is known, else the
    account id, else the person id."""
    account, person, raw = column(account), column(person), column(raw)
    own_account = F.concat(F.lit(V.ACCOUNT_PREFIX), account) if prefix else account
    own_person = F.concat(F.lit(V.PERSON_PREFIX), person) if prefix else person
    return (F.when((account == V.UNKNOWN_ID) & (person == V.UNKNOWN_ID), raw)
            .when(person == V.UNKNOWN_ID, own_account)
            .otherwise(own_person))


def resolve_identity_by_type(account: Column | str, person: Column | str, raw: Column | str,
                             customer_type: Column | str) -> Column:
    """The variant that trusts the declared customer type over the person id."""
    account, person = column(account), column(person)
    return (F.when((account == V.UNKNOWN_ID) & (person == V.UNKNOWN_ID), column(raw))
            .when(F.upper(column(customer_type)) == "HCP", F.concat(F.lit(V.ACCOUNT_PREFIX), account))
            .otherwise(F.concat(F.lit(V.PERSON_PREFIX), person)))


def record_owner(account: Column | str, person: Column | str) -> Column:
    account, person = column(account), column(person)
    return F.when(person == V.UNKNOWN_ID, account).otherwise(person)


def identified_flag(account: Column | str, person: Column | str) -> Column:
    unknown = (column(account) == V.UNKNOWN_ID) & (column(person) == V.UNKNOWN_ID)
    return F.when(unknown, "N").otherwise("Y")


def known_customer(key: Column | str) -> Column:
    key = column(key)
    return F.when(key.isNull() | (key == "NA"), "N").otherwise("Y")


def normalize_class(c: Column | str) -> Column:
    up = F.upper(column(c))
    return (F.when(up == "OTHER", "CONTACT")
            .when(up.like("%PATIENT%") | up.like("%CAREGIVER%"), "PATIENT")
            .otherwise(up))


def contact_as_patient(c: Column | str) -> Column:
    c = column(c)
    return F.when(F.upper(c) == "CONTACT", "PATIENT").otherwise(c)


def party_key(customer: Column | str, party_class: Column | str) -> Column:
    """Prefix by class: professionals and organisations are accounts, all others persons."""
    customer, party_class = column(customer), column(party_class)
    return (F.when(party_class.like("%HCP%") | party_class.like("%HCO%"),
                   F.concat(F.lit(V.ACCOUNT_PREFIX), customer))
            .otherwise(F.concat(F.lit(V.PERSON_PREFIX), customer)))


def long_key(c: Column | str) -> Column:
    """Attendee ids of 17 or more characters are account ids and get the account prefix."""
    c = column(c)
    return F.when(F.length(c) >= 17, F.concat(F.lit(V.ACCOUNT_PREFIX), c)).otherwise(c)
