"""Transcript files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollbook.functions.staging import stage
from rollbook.operators.lookup import with_match
from rollbook.plans.reports import LINE_ORDER

# Header names of the transcript file, in order.
CSV_HEADER = {
    "student_id": "Student ID",
    "first_name": "First",
    "last_name": "Last",
    "email": "Email",
    "course_code": "Code",
    "course_name": "Course",
    "credits": "Credits",
    "semester": "Semester",
    "final_score": "Avg Score",
    "letter_grade": "Grade",
}


def export_csv(transcripts: DataFrame, path: str, per_student: bool = False) -> None:
    """Transcripts as CSV: NULL an empty field, quotes doubled, CRLF line ends.

    ``per_student`` gives one folder per student, named by id.  A very long
    transcript spans several files there, because the range partitioning also
    cuts between the rows of one student.
    """
    order = ["student_id", "course_code", "semester"]
    rows = transcripts.repartitionByRange(*order).sortWithinPartitions(*order)
    out = rows.select(*[F.col(c).alias(h) for c, h in CSV_HEADER.items()])
    if per_student:
        out = out.withColumn("student_id", F.col("Student ID"))
    writer = (
        out.write.option("header", True)
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("escape", '"')
        .option("lineSep", "\r\n")
    )
    (writer.partitionBy("student_id") if per_student else writer).csv(path)


def export_packed(transcripts: DataFrame, path: str) -> None:
    """One CSV file per student, many of them packed into each of few files, with an index.

    ``path/files`` holds the files, range-partitioned by student: their number goes
    with the size, not with the students.  ``path/index`` says where the bytes of a
    student are (student_id, part, file, at, size); those of a very long transcript
    may be in several files, in the order of ``part``.
    """
    spark = transcripts.sparkSession
    order = ["student_id", "course_code", "semester"]
    csv = F.to_csv(F.struct(*[F.col(c).alias(h) for c, h in CSV_HEADER.items()]), {"escape": '"', "nullValue": "", "emptyValue": ""})
    lines = transcripts.select(*order, F.lit(1).alias("rank"), csv.alias("line"))
    head = transcripts.select("student_id").distinct().withColumns(
        {"course_code": F.lit(None).cast("string"), "semester": F.lit(None).cast("string"), "rank": F.lit(0), "line": F.lit(",".join(CSV_HEADER.values()))}
    )
    keys = ["student_id", "rank", "course_code", "semester"]
    cut = lines.unionByName(head).repartitionByRange(*keys).sortWithinPartitions(*keys)
    cut = stage(cut.select("student_id", "line", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")))
    written = cut.repartition("part").sortWithinPartitions("part", "place").select("part", "line")
    written.write.option("lineSep", "\r\n").partitionBy("part").text(f"{path}/files")
    size = F.octet_length("line") + 2
    before = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placed = cut.select("student_id", "part", size.alias("size"), F.coalesce(F.sum(size).over(before), F.lit(0)).alias("at"))
    spans = placed.groupBy("student_id", "part").agg(F.min("at").alias("at"), F.sum("size").alias("size"))
    files = spark.read.format("binaryFile").load(f"{path}/files").select("part", F.col("path").alias("file"))
    spans = spans.join(files, "part").select("student_id", "part", "file", "at", "size")
    spans.repartitionByRange("student_id").sortWithinPartitions("student_id").write.parquet(f"{path}/index")


def read_packed(spark: SparkSession, path: str, students: DataFrame) -> DataFrame:
    """(student_id, csv) of the students asked for, from the files that the index names.

    The index is sorted by student, and files without any of them are not read.
    """
    spans = stage(with_match(spark.read.parquet(f"{path}/index"), students, ["student_id"]))
    files = spark.read.format("binaryFile").load(f"{path}/files").select("part", "content")
    found = files.join(spans.groupBy("part").agg(F.collect_list(F.struct("student_id", "at", "size")).alias("spans")), "part")
    found = found.select("part", "content", F.explode("spans").alias("span"))
    text = F.expr("decode(substring(content, cast(span.at + 1 as int), cast(span.size as int)), 'UTF-8')")
    pieces = found.select("span.student_id", F.struct("part", text.alias("text")).alias("piece"))
    whole = F.transform(F.array_sort(F.collect_list("piece")), lambda x: x["text"])
    return pieces.groupBy("student_id").agg(F.array_join(whole, "").alias("csv"))


def export_text(lines: DataFrame, path: str, per_student: bool = False) -> None:
    """Transcript lines as text files in reading order.

    Takes the rows of ``transcript_lines`` or ``transcript_listing``.
    """
    rows = lines.repartitionByRange(*LINE_ORDER).sortWithinPartitions(*LINE_ORDER)
    if per_student:
        rows.select("student_id", "line").write.partitionBy("student_id").text(path)
    else:
        rows.select("line").write.text(path)
