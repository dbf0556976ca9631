"""SQL for the queries of this subpackage that SQL can express."""

_TOKEN = "[一-鿿㐀-䶿]|[a-zA-Z0-9]+"


def oracle_sql() -> dict[str, str]:
    return {
        "p3_found": f"SELECT DISTINCT id FROM chunks WHERE len(regexp_extract_all(content, '{_TOKEN}')) > 384",
    }
