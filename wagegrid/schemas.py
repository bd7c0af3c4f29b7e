"""Fixed schemas of the posting tables; nothing is inferred."""

from pyspark.sql import types as T


def _fields(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in kinds.items()])


_S, _D, _TS = T.StringType(), T.DoubleType(), T.TimestampType()

SEARCH_RESULTS = _fields(
    search_datetime=_TS, search_title=_S, search_location=_S,
    title=_S, location=_S, company=_S, job_id=_S,
)

NEW_IDS = _fields(
    job_id=_S, new_search_datetime=_TS, title=_S, location=_S,
    company=_S, search_title=_S, search_location=_S,
)

JOB_DETAILS = _fields(
    job_id=_S, search_datetime=_TS, location=_S, search_title=_S, search_location=_S,
    search_detail_datetime=_TS, title=_S, job_desc=_S, company=_S,
    company_rating=_D, company_rating_count=T.IntegerType(),
)

LISTINGS_RAW = _fields(Title=_S, Location=_S, Company=_S, Salary=_S, Synopsis=_S)

LISTINGS_CLEAN = T.StructType(
    _fields(
        Title=_S, Location=_S, Company=_S, Synopsis=_S,
        Low=_D, High=_D, Average=_D, City=_S, State=_S,
    ).fields
    + [T.StructField("State Initials", _S, True)]
)

PAGES = _fields(page_id=T.LongType(), url=_S, html=_S)

SEARCH_REQUEST = _fields(titles=_S, locations=_S)
