"""Contact details: site scan, finder work list, finder lookup table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlake.operators.merge import reduce_batch
from leadlake.operators.site import finder_domain, wants_email


def finder_worklist(businesses: DataFrame) -> DataFrame:
    """Good leads without an address: (place_id, name, lookup_domain, status). No domain means 'not_found' at once."""
    wanted = businesses.where(wants_email()).select("place_id", "name", finder_domain().alias("lookup_domain"))
    return wanted.withColumn("status", F.when(F.col("lookup_domain").isNull(), "not_found").otherwise("to_look_up"))


def finder_answers(finder: DataFrame) -> DataFrame:
    """One answer per domain from a finder table (domain, email, status): an answer with an address is preferred."""
    ranked = finder.withColumns({"_has": F.col("email").isNotNull(), "_status": F.col("status"), "_email": F.col("email")})
    return reduce_batch(ranked, ["domain"], ["_has", "_status", "_email"],
                        {"email": "overwrite", "status": "overwrite"}).where(F.col("domain").isNotNull())


def with_finder(businesses: DataFrame, applies, finder: DataFrame | None = None) -> DataFrame:
    """Fill email and email_status from the finder for rows where `applies` holds and an address is wanted.

    Without a finder table the answer is (NULL, not_attempted); a domain the table does not know is not_found.
    """
    asked = F.coalesce(applies, F.lit(False)) & wants_email()
    work = businesses.withColumns({"_asked": asked, "_domain": F.when(asked, finder_domain())})
    if finder is None:
        found_email, found_status = F.lit(None).cast("string"), F.lit("not_attempted")
    else:
        answers = finder_answers(finder).select(
            F.col("domain").alias("_domain"), F.col("email").alias("_found"), F.col("status").alias("_found_status"))
        work = work.join(answers, "_domain", "left")
        found_email, found_status = F.col("_found"), F.coalesce("_found_status", F.lit("not_found"))
    has_domain = F.col("_domain").isNotNull()
    return work.withColumns({
        "email": F.when(F.col("_asked") & has_domain, found_email).otherwise(F.col("email")),
        "email_status": F.when(F.col("_asked"), F.when(has_domain, found_status).otherwise("not_found"))
        .otherwise(F.col("email_status")),
    }).drop("_asked", "_domain", "_found", "_found_status")
