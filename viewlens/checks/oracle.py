"""All oracle SQL strings, keyed like the query registry."""

from viewlens.checks import sql_classify, sql_content, sql_marts, sql_rfm, sql_search


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for mod in (sql_rfm, sql_content, sql_search, sql_marts, sql_classify):
        out.update(mod.SQL)
    return out
