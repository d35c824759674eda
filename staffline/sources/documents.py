"""Landed document sources.

Production input is JSON landed by the extraction step (one HR page or one
directory export per file); ``read_*`` parse it with a fixed schema (no
inference pass over 100 TB). The ``*_from_tables`` builders derive documents
of the same shape from the supplied test tables, so flattening is exercised
on data that grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

#: Column that holds the text of a document that does not parse; flattening fails on it or quarantines it.
CORRUPT = "_corrupt_record"

_NAME_CODE = "struct<codeValue: string, shortName: string, longName: string>"
WORKER_SCHEMA = (
    "struct<associateOID: string, "
    "workAssignments: array<struct<primaryIndicator: boolean, payrollFileNumber: string, hireDate: string, "
    "actualStartDate: string, seniorityDate: string, fullTimeEquivalenceRatio: double, "
    "managementPositionIndicator: boolean, homeWorkLocation: struct<nameCode: " + _NAME_CODE + ">, "
    "assignedOrganizationalUnits: array<struct<nameCode: " + _NAME_CODE + ">>, "
    "reportsTo: array<struct<positionID: string>>, jobCode: " + _NAME_CODE + ", "
    "workerTypeCode: struct<shortName: string, longName: string>>>, "
    "person: struct<legalName: struct<givenName: string, middleName: string, familyName1: string>, "
    "preferredName: struct<givenName: string, middleName: string, familyName1: string>, "
    "genderCode: struct<longName: string>, preferredGenderPronounCode: struct<shortName: string>, "
    "birthDate: string, communication: struct<emails: array<struct<emailUri: string>>, "
    "mobiles: array<struct<formattedNumber: string>>>, legalAddress: struct<lineOne: string, lineTwo: string, "
    "cityName: string, countrySubdivisionLevel1: struct<codeValue: string>, postalCode: string>>, "
    "businessCommunication: struct<emails: array<struct<emailUri: string>>>, "
    "workerStatus: struct<statusCode: struct<codeValue: string>>, "
    "workerDates: struct<originalHireDate: string, terminationDate: string>, "
    "customFieldGroup: struct<dateFields: array<struct<dateValue: string>>>>")
WORKER_PAGE_SCHEMA = f"struct<workers: array<{WORKER_SCHEMA}>>"
TIMECARD_SCHEMA = (
    "struct<timeCards: array<struct<associateOID: string, timePeriod: struct<startDate: string>, "
    "dailyTotals: array<struct<entryDate: string, timeDuration: string, "
    "payCode: struct<codeValue: string, shortName: string>>>>>>")
DIRECTORY_SCHEMA = (
    "objectGUID string, givenName string, sn string, cn string, displayName string, "
    "userPrincipalName string, mail string, title string, sAMAccountName string, "
    "distinguishedName string, department string, physicalDeliveryOfficeName string, manager string, "
    "description string, telephoneNumber string, mobile string, proxyAddresses array<string>, "
    "whenCreated timestamp, userAccountControl int")


def _with_corrupt(struct_type: str) -> StructType:
    """The fixed schema (a struct, or a list of columns) plus the column for text that does not parse."""
    return DataType.fromDDL(struct_type).add(CORRUPT, "string")


def _read(spark: SparkSession, path: str, schema: str, multi_line: bool) -> DataFrame:
    return (spark.read.schema(_with_corrupt(schema)).option("columnNameOfCorruptRecord", CORRUPT)
            .option("multiLine", multi_line).json(path))


def read_worker_pages(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Landed worker pages (``{"workers": [...]}``), one per line, or one per
    file with ``multi_line``. A page that does not parse keeps its text in ``_corrupt_record``."""
    return _read(spark, path, WORKER_PAGE_SCHEMA, multi_line)


def read_timecards(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Landed timecard documents (``{"timeCards": [...]}``), read like worker pages."""
    return _read(spark, path, TIMECARD_SCHEMA, multi_line)


def read_directory(spark: SparkSession, paths: dict) -> DataFrame:
    """Directory exports of several servers, one entry per line, tagged with their ``source``. An
    entry that does not parse keeps its text in ``_corrupt_record``."""
    out = None
    for source, path in paths.items():
        df = _read(spark, path, DIRECTORY_SCHEMA, False).withColumn("source", F.lit(source))
        out = df if out is None else out.unionByName(df)
    return out


def parse(docs: DataFrame, text_col: str, schema: str, keep: list[str] | None = None) -> DataFrame:
    """Parse JSON text (one document per row) with a fixed schema; text that
    does not parse is kept in ``_corrupt_record``. Columns named in ``keep`` stay."""
    parsed = F.from_json(text_col, _with_corrupt(schema), {"columnNameOfCorruptRecord": CORRUPT})
    return docs.select(parsed.alias("__d"), *(keep or [])).select("__d.*", *(keep or []))


def unparsed(docs: DataFrame, list_col: str):
    """Whether a landed document is unusable: text that does not parse, or no list where one belongs."""
    bad = F.col(list_col).isNull()
    return (F.col(CORRUPT).isNotNull() | bad) if CORRUPT in docs.columns else bad


def worker_documents_from_tables(customer: DataFrame, job_titles: DataFrame) -> DataFrame:
    """One worker JSON document per customer (column ``doc``)."""
    k = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    # A remainder by 50 meets no other titles.
    title = (job_titles.where(F.col("job_title_id").between(-49, 49))
             .groupBy("job_title_id").agg(F.min("job_title").alias("__title")))
    c = customer.join(title, (k % 50).cast("int") == F.col("job_title_id"), "left")
    # Rows are short and documents long: a small file, or the few keys of the join, would leave all documents to a few tasks.
    c = c.repartition(int(customer.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def day(first: str, spread: int):
        return F.date_format(F.date_add(F.lit(first).cast("date"), (k % spread).cast("int")), "yyyy-MM-dd")

    primary = F.struct(
        F.lit(True).alias("primaryIndicator"), F.format_string("%06d", k).alias("payrollFileNumber"),
        F.when(k % 17 == 0, F.lit("2023-10-01")).otherwise(day("1995-01-01", 1500)).alias("hireDate"),
        F.date_format(F.date_add(F.lit("1995-01-01").cast("date"), (k % 1500).cast("int")), "yyyy-MM-dd").alias("actualStartDate"),
        F.struct(F.struct(F.col("c_nationkey").cast("string").alias("codeValue"),
                          F.concat(F.lit("Site "), F.col("c_nationkey").cast("string")).alias("shortName")).alias("nameCode"))
        .alias("homeWorkLocation"),
        F.array(F.struct(F.struct(F.lit("1").alias("codeValue"), F.lit(None).cast("string").alias("longName")).alias("nameCode")),
                F.struct(F.struct((k % 12).cast("string").alias("codeValue"),
                                  F.concat((k % 12).cast("string"), F.lit(" - Department "), (k % 12).cast("string")).alias("longName"))
                         .alias("nameCode"))).alias("assignedOrganizationalUnits"),
        F.when(k % 9 != 0, F.array(F.struct(F.concat(F.lit("S3600"), F.format_string("%06d", k % 50)).alias("positionID"))))
        .alias("reportsTo"),
        F.struct((k % 50).cast("string").alias("codeValue"),
                 F.coalesce(F.col("__title"), F.concat(F.lit("Title "), (k % 50).cast("string"))).alias("longName")).alias("jobCode"),
        F.struct(F.when(k % 2 == 0, "Full Time").alias("longName"), F.lit("FT").alias("shortName")).alias("workerTypeCode"),
        (F.col("c_acctbal") / 10000).alias("fullTimeEquivalenceRatio"),
        (k % 10 == 0).alias("managementPositionIndicator"),
        F.when(k % 5 != 0, day("1994-06-01", 1400)).alias("seniorityDate"))
    # A secondary assignment (same shape, not primary) that the extractors must skip.
    other = primary.withField("primaryIndicator", F.lit(False)).withField("payrollFileNumber", F.lit("999999"))
    worker = F.struct(
        F.concat(F.lit("G"), F.format_string("%015d", k)).alias("associateOID"),
        F.array(other, primary).alias("workAssignments"),
        F.struct(F.struct(seg.alias("givenName"), F.when(k % 3 != 0, F.lit("Quinn")).alias("middleName"),
                          F.concat(F.lit("Name"), k.cast("string")).alias("familyName1")).alias("legalName"),
                 F.struct(F.when(k % 6 == 0, F.concat(F.lit("Pref"), k.cast("string"))).alias("givenName"),
                          F.when(k % 12 == 0, F.lit("Mid")).alias("middleName"),
                          F.when(k % 18 == 0, F.lit("Last")).alias("familyName1")).alias("preferredName"),
                 F.struct(F.when(k % 2 == 0, "Female").otherwise("Male").alias("longName")).alias("genderCode"),
                 F.struct(F.when(k % 7 == 0, F.lit("they/them")).alias("shortName")).alias("preferredGenderPronounCode"),
                 F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), (k % 9000).cast("int")), "yyyy-MM-dd").alias("birthDate"),
                 F.struct(F.when(k % 4 != 0, F.array(F.struct(F.concat(F.lit("P"), k.cast("string"), F.lit("@Mail.example")).alias("emailUri"))))
                          .alias("emails"),
                          F.when(k % 3 == 0, F.array(F.struct(F.concat(F.lit("(530) 555-"), F.lpad((k % 10000).cast("string"), 4, "0"))
                                                              .alias("formattedNumber")))).alias("mobiles")).alias("communication"),
                 F.struct(F.concat(k.cast("string"), F.lit(" Main St")).alias("lineOne"),
                          F.when(k % 8 == 0, F.concat(F.lit("Apt "), k.cast("string"))).alias("lineTwo"), F.lit("Davis").alias("cityName"),
                          F.struct(F.lit("CA").alias("codeValue")).alias("countrySubdivisionLevel1"),
                          F.concat(F.lit("95"), F.lpad((k % 1000).cast("string"), 3, "0"), F.lit("-1234")).alias("postalCode"))
                 .alias("legalAddress")).alias("person"),
        F.struct(F.array(F.struct(F.concat(seg, F.lit("."), k.cast("string"), F.lit("@Example.org")).alias("emailUri")))
                 .alias("emails")).alias("businessCommunication"),
        F.struct(F.struct(F.when(F.col("c_acctbal") < 0, "Terminated").otherwise("Active").alias("codeValue"))
                 .alias("statusCode")).alias("workerStatus"),
        F.struct(F.when(k % 4 != 0, day("1993-01-01", 1100)).alias("originalHireDate"),
                 F.when(F.col("c_acctbal") < 0, F.lit("2000-06-30")).alias("terminationDate")).alias("workerDates"),
        F.struct(F.array(F.struct(F.lit(None).cast("string").alias("dateValue")),
                         F.struct(F.when(k % 3 == 1, day("2001-01-01", 300)).alias("dateValue")),
                         F.struct(F.when(k % 9 == 0, day("1992-01-01", 900)).alias("dateValue"))).alias("dateFields"))
        .alias("customFieldGroup"))
    return c.select(F.to_json(F.struct(F.array(worker).alias("workers"))).alias("doc"))


def timecard_documents_from_tables(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """One timecard JSON document per order, one time card per line.

    JSON cost is per document, so cards are grouped; a group is bounded by
    the lines of one order."""
    pay = (F.when(F.col("l_linenumber") == 1, "REGULAR").when(F.col("l_linenumber") == 2, "REGSAL")
           .when(F.col("l_linenumber") == 3, "OVERTIME").when(F.col("l_linenumber") == 4, "PTO")
           .when(F.col("l_linenumber") == 5, "UNPAID").otherwise("ZZZ"))
    q = F.col("l_quantity").cast("int")
    card = F.struct(
        F.concat(F.lit("G"), F.format_string("%015d", F.col("o_custkey"))).alias("associateOID"),
        F.struct(F.date_format(F.trunc(F.col("l_shipdate").cast("date"), "month"), "yyyy-MM-dd").alias("startDate")).alias("timePeriod"),
        F.array(F.struct(
            F.when(F.col("l_linenumber") != 7, F.date_format(F.col("l_shipdate").cast("date"), "yyyy-MM-dd")).alias("entryDate"),
            F.concat(F.lit("PT"), (q % 12).cast("string"), F.lit("H"), q.cast("string"), F.lit("M")).alias("timeDuration"),
            F.struct(pay.alias("codeValue"), F.lower(pay).alias("shortName")).alias("payCode"))).alias("dailyTotals"))
    lines = lineitem.join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return (lines.groupBy("l_orderkey").agg(F.collect_list(card).alias("timeCards"))
            .select(F.to_json(F.struct("timeCards")).alias("doc")))


def directory_entries_from_tables(customer: DataFrame) -> DataFrame:
    """One directory entry per customer, alternating between two servers."""
    k = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    src = F.when(k % 2 == 0, "server1").otherwise("server2")
    ou = F.when(k % 2 == 0, F.concat(F.lit("CN=x,OU=Group"), (k % 7).cast("string"), F.lit(",OU=Staff,OU=Users,DC=org,DC=local")))
    ou = ou.otherwise(F.concat(F.lit("CN=x,OU=Group"), (k % 7).cast("string"), F.lit(",OU=Users,DC=org,DC=local")))
    return customer.select(
        F.concat(F.lit("{g-"), k.cast("string"), F.lit("}")).alias("objectGUID"),
        F.concat(F.lit("  "), F.lower(seg), F.lit("-o'neil ")).alias("givenName"),
        F.concat(F.lit("name"), k.cast("string")).alias("sn"),
        F.concat(seg, F.lit(" Name"), (k % 300).cast("string")).alias("cn"),
        F.when(k % 5 != 0, F.concat(F.lower(seg), F.lit(" mc"), F.lower(seg))).alias("displayName"),
        F.concat(F.lit(" "), seg, F.lit("."), k.cast("string"), F.lit("@Example.ORG\t")).alias("userPrincipalName"),
        F.when(k % 4 != 0, F.concat(F.lit("U"), (k % 97).cast("string"), F.lit("@Example.org"))).alias("mail"),
        F.concat(F.lit(" "), seg, F.lit(" ")).alias("title"),
        F.concat(F.lit("ACC"), k.cast("string")).alias("sAMAccountName"),
        ou.alias("distinguishedName"),
        F.lit(" Dept ").alias("department"),
        F.when(k % 2 == 0, F.concat(F.lit(" Site "), (k % 25).cast("string"))).alias("physicalDeliveryOfficeName"),
        F.when(k % 3 == 0, F.concat(F.lit("CN=Boss "), (k % 11).cast("string"), F.lit(",OU=Users,DC=org"))).alias("manager"),
        F.when(k % 7 != 0, F.concat(F.lit(" Staff "), k.cast("string"))).alias("description"),
        F.when(k % 8 != 0, F.concat(F.lit("x"), (k % 1000).cast("string"))).alias("telephoneNumber"),
        F.when(k % 9 == 0, F.concat(F.lit("(530) 555-"), F.lpad((k % 10000).cast("string"), 4, "0"))).alias("mobile"),
        F.when(k % 6 != 0, F.array(F.concat(F.lit("smtp:alias"), k.cast("string"), F.lit("@x.org")),
                                   F.concat(F.lit("SMTP:Primary."), k.cast("string"), F.lit("@Example.org"))))
        .alias("proxyAddresses"),
        F.timestamp_seconds(F.lit(946684800) + (k % 3600) + F.lit(0.5)).alias("whenCreated"),
        F.when(k % 3 == 0, 512).when(k % 3 == 1, 66048).otherwise(514).alias("userAccountControl"),
        src.alias("source"))
