"""Relevance annotations, ``topic-grade`` strings on documents."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def well_formed(annotation: Column) -> Column:
    """Whether the annotation has exactly two parts."""
    return F.coalesce(F.size(F.split(annotation, "-")) == 2, F.lit(False))


def topic_of(annotation: Column) -> Column:
    return F.when(well_formed(annotation), F.get(F.split(annotation, "-"), 0))


def grade_of(annotation: Column) -> Column:
    """The grade, 0 where it is not a number; NULL where the annotation is malformed."""
    grade = F.get(F.split(annotation, "-"), 1).try_cast("int")
    return F.when(well_formed(annotation), F.coalesce(grade, F.lit(0)))


def grade_for_topic(annotation: Column, topic_id: Column) -> Column:
    """The grade of a document for a topic: 0 if empty, malformed, or judged for another topic."""
    return F.coalesce(F.when(topic_of(annotation) == topic_id, grade_of(annotation)), F.lit(0))


def has_topic_prefix(annotation: Column, prefixes: list[str]) -> Column:
    """Whether the annotation starts with one of the topic prefixes."""
    starts = [F.startswith(annotation, F.lit(p)) for p in prefixes]
    return F.coalesce(reduce(or_, starts, F.lit(False)), F.lit(False))
