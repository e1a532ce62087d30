"""E-mail campaigns: recipients, volume, message texts and lists. Nothing is sent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from crashlake.operators import common as C


def _matching(reports: DataFrame, product: str, versions: list[str], signature: str | None,
              start, end) -> DataFrame:
    r = reports.where((F.col("date_processed") >= F.lit(start).cast("timestamp"))
                      & (F.col("date_processed") < F.lit(end).cast("date").cast("timestamp")
                         + F.expr("INTERVAL 86399 SECOND")) & (F.col("product") == product))
    if versions:
        r = r.where(F.col("version").isin(versions))
    return r if signature is None else r.where(F.col("signature") == signature)


def contacted(campaigns: DataFrame, sent: DataFrame, contacts: DataFrame, product: str,
              signature: str | None) -> DataFrame:
    """E-mails that earlier campaigns on the product and signature have reached."""
    c = campaigns.where(F.col("product") == product)
    if signature is not None:
        c = c.where(F.col("signature") == signature)
    return (c.select(F.col("id").alias("email_campaigns_id"))
            .join(sent.select("email_campaigns_id", "email_contacts_id"), "email_campaigns_id")
            .join(contacts.select(F.col("id").alias("email_contacts_id"), "email"),
                  "email_contacts_id").select("email"))


def not_in(df: DataFrame, col: str, listed: DataFrame) -> DataFrame:
    """SQL ``NOT IN`` with its NULL rules, without broadcasting the list.

    With an empty list every row stays; a NULL in the list keeps none; a NULL value stays
    only when the list is empty.
    """
    keys = listed.select(F.col(listed.columns[0]).alias("_k"))
    size = keys.agg(F.count(F.lit(1))).scalar()
    nulls = keys.agg(F.count(F.when(F.col("_k").isNull(), 1))).scalar()
    rest = df.join(keys, F.col(col) == F.col("_k"), "left_anti")
    return rest.where((size == 0) | ((nulls == 0) & F.col(col).isNotNull()))


def campaign_recipients(reports: DataFrame, contacts: DataFrame, campaigns: DataFrame,
                        sent: DataFrame, product: str, versions: list[str],
                        signature: str | None, start, end) -> DataFrame:
    """One row per address with its latest crash: not opted out, not contacted before.

    As in the query this follows, an address without a contact row is listed only while no
    one has been contacted.
    """
    r = _matching(reports, product, versions, signature, start, end) \
        .where(F.length("email") > 4).select("email", "client_crash_date", "uuid")
    c = contacts.select(F.col("id").alias("contact_id"), F.col("email").alias("_contact"),
                        "subscribe_status", "subscribe_token")
    # one row per address first, so that the join does not grow with the crashes
    latest = r.groupBy("email").agg(
        F.max_by(F.struct("client_crash_date", "uuid"),
                 F.struct("client_crash_date", "uuid")).alias("l"))
    rows = latest.join(c, F.col("email") == F.col("_contact"), "left") \
        .where(F.coalesce("subscribe_status", F.lit(True)))
    rows = not_in(rows, "_contact", contacted(campaigns, sent, contacts, product, signature))
    return rows.select("contact_id", "email", F.col("l.client_crash_date").alias("crash_date"),
                       F.col("l.uuid").alias("uuid"), "subscribe_token")


def campaign_volume(reports: DataFrame, product: str, versions: list[str], signature: str | None,
                    start, end) -> DataFrame:
    """Number of distinct addresses that look deliverable."""
    r = _matching(reports, product, versions, signature, start, end)
    return r.where(F.col("email").rlike(r".*@.*\.[a-zA-Z]{2,4}")) \
        .agg(F.countDistinct("email").alias("total"))


def render_messages(recipients: DataFrame, body: Column, unsubscribe_base: str,
                    crash_base: str, marks: dict[str, str] | None = None) -> DataFrame:
    """Fill the marks of a message per recipient; ``%s`` in a base takes the token or id."""
    names = {"email": "*|EMAIL_ADDRESS|*", "unsubscribe": "*|UNSUBSCRIBE_URL|*",
             "date": "*|CRASH_DATE|*", "url": "*|CRASH_URL|*", **(marks or {})}

    def link(base: str, value: Column) -> Column:
        head, _, tail = base.partition("%s")
        return F.concat(F.lit(head), F.coalesce(value, F.lit("")), F.lit(tail))
    text = body
    for mark, value in (
            (names["email"], F.col("email")),
            (names["unsubscribe"], link(unsubscribe_base, F.col("subscribe_token"))),
            (names["date"], F.date_format("crash_date", "yyyy-MM-dd'T'HH:mm:ss")),
            (names["url"], link(crash_base, F.col("uuid")))):
        text = F.replace(text, F.lit(mark), value)
    return recipients.withColumn("message", text)


def campaign_page(campaigns: DataFrame, number: int, size: int = 50) -> DataFrame:
    """One page of campaigns, newest first."""
    return C.page(campaigns, [F.desc("id")], size, number)


def campaign_page_count(campaigns: DataFrame, size: int = 50) -> DataFrame:
    return C.page_count(campaigns, size)


def campaign_status(sent: DataFrame, campaign_id: int | None = None) -> DataFrame:
    """Contacts of a campaign (or of all of them) by status."""
    rows = sent if campaign_id is None else sent.where(F.col("email_campaigns_id") == campaign_id)
    return rows.groupBy("email_campaigns_id", "status").agg(F.count("status").alias("count"))
