"""Course and module id extraction as column expressions.

Ids arrive in many spellings: ``ORG/NUM/TERM``, ``course-v1:ORG+NUM+TERM``,
``block-v1:ORG+NUM+TERM+type@problem+block@abc``, ``i4x://ORG/NUM/problem/abc``
and URLs containing any of these.  Everything here is built from Spark string
functions, so it runs inside whole-stage codegen.

Deviations from the source (on purpose): the ``i4x://`` prefix is removed as a
prefix (the source strips a character set), three-level lookups read the real
nested path, and a record with no usable candidate gets a NULL course id.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mooclens.functions.columns import col


# scheme and host of a URL, in front of its path
_HOST = r"(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?"


def url_path(c, prefix: str = "") -> Column:
    """Path part of a URL-ish string, as a URL parser would return it:
    drop ``scheme:``, ``//netloc``, ``?query``/``#fragment`` and ``;params`` of
    the last segment.  ``prefix`` is a text to drop before them where it leads."""
    s = F.regexp_replace(col(c), f"^(?:{prefix})?{_HOST}", "")
    s = F.regexp_replace(s, r"[?#].*$", "")
    return F.regexp_replace(s, r";[^/]*$", "")


def _after_first_colon(s: Column) -> Column:
    """Text after the first ``:`` (whole text when absent)."""
    return F.substring(s, F.locate(":", s) + 1, F.lit(2**31 - 1))


def _first_segments(s: Column, n: int) -> Column:
    """Join the first ``n`` non-empty ``/`` segments."""
    return F.substring_index(F.btrim(F.regexp_replace(s, "/+", "/"), F.lit("/")), "/", n)


def _after_last(s: Column, token: str) -> Column:
    """Text after the last occurrence of ``token`` (whole text when absent)."""
    return F.substring_index(s, token, -1)


def course_id_from_text(c) -> Column:
    """Normalise a course-id candidate to ``ORG/NUM/TERM``."""
    s = _after_last(col(c), "courses/")
    old_style = s.contains("i4x:") | s.contains("data:image")
    head = F.substring_index(s, ":", 1)                       # before the first ':'
    plus = F.when(old_style, head).otherwise(_after_first_colon(s))
    segs = F.replace(F.substring_index(plus, "+", 3), F.lit("+"), F.lit("/"))
    return _first_segments(F.regexp_replace(segs, "/+$", ""), 3)


def course_id_candidate(record: Column | None = None) -> Column:
    """Raw course-id text of a log record (struct with ``course_id``,
    ``context``, ``page``, ``event_type``, ``name``): its own field, else the
    context's, else the URL path of the first path-like candidate (page, event
    type, context path, name).  NULL when nothing qualifies."""
    def f(name):
        return record.getField(name) if record is not None else F.col(name)

    own = F.nullif(f("course_id"), F.lit(""))
    ctx = F.nullif(f("context").getField("course_id"), F.lit(""))
    paths = [F.when(c.contains("/") | c.contains("+"), url_path(c)) for c in [f("page"), f("event_type"), f("context").getField("path"), f("name")]]
    # an empty path is none; taken out of a list, as a comparison would work each path out twice
    return F.coalesce(own, ctx, *[F.get(F.array_remove(F.array(p), ""), 0) for p in paths])


def log_course_id(record: Column | None = None) -> Column:
    """Course id of a log record (see ``course_id_candidate``)."""
    return course_id_from_text(course_id_candidate(record))


def module_id_from_text(c) -> Column:
    """Normalise a module-id candidate to at most 5 ``/`` segments."""
    s = url_path(c, "i4x://")
    s = _after_last(s, "course-v1:")
    s = _after_first_colon(_after_last(s, "courses/"))
    # of each '+' segment the text after its last '@'; plain string functions, as a lambda would take
    # the whole expression out of the generated code
    s = F.regexp_replace(s, "(?<![^+@])[^+@]*+@", "")
    return _first_segments(F.replace(s, F.lit("+"), F.lit("/")), 5)


def module_id_candidate(record: Column | None = None) -> Column:
    """Raw module-id text: the first of eight candidate fields that contains
    one of ``/ - + @`` (context module usage key, page, context path, event
    payload's event type, name, payload id, payload problem id, event type)."""
    def f(*path):
        c = record.getField(path[0]) if record is not None else F.col(path[0])
        for p in path[1:]:
            c = c.getField(p)
        return c

    cands = [f("context", "module", "usage_key"), f("page"), f("context", "path"), f("event_obj", "event_type"),
             f("name"), f("event_obj", "id"), f("event_obj", "problem_id"), f("event_type")]
    chosen = None
    for c in cands:
        ok = c.rlike("[-/+@]") & (c != "i4x://")
        chosen = F.when(ok, c) if chosen is None else chosen.when(ok, c)
    return chosen


def log_module_id(record: Column | None = None) -> Column:
    """Module id of a log record (see ``module_id_candidate``)."""
    return module_id_from_text(module_id_candidate(record))


def clean_course_id(c) -> Column:
    """Course id of a database dump row: after the last ``:``, ``+`` -> ``/``."""
    return F.regexp_replace(F.element_at(F.split(col(c), ":"), -1), r"\+", "/")


def course_from_block(c) -> Column:
    """``block-v1:ORG+NUM+TERM+type@x+block@y`` or ``i4x://ORG/NUM/...`` -> course id."""
    s = col(c)
    i4x = F.regexp_replace(F.element_at(F.split(s, "//"), -1), "course/", "")
    plus = F.split(F.element_at(F.split(s, ":"), -1), r"\+", 4)
    return F.when(s.startswith("i4x://"), i4x).otherwise(F.array_join(F.slice(plus, 1, 3), "/"))


def module_from_block(c) -> Column:
    """Block id -> ``ORG/NUM/TERM/type/id`` module id."""
    s = F.replace(col(c), F.lit("/courses/course-v1:"), F.lit(""))
    i4x = F.regexp_replace(s, "^i4x://", "")
    tail = F.regexp_replace(s, "^[^:]*:", "")
    parts = F.transform(F.split(tail, r"\+"), lambda p: F.element_at(F.split(p, "@"), -1))
    joined = F.array_join(parts, "/")
    first5 = F.array_join(F.slice(F.split(joined, "/"), 1, 5), "/")
    return F.when(s.startswith("i4x://"), i4x).otherwise(first5)
