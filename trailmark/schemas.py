"""Schemas of the nested log records, as DDL. '' and 0 stand for absent values."""

USER_INFO = "STRUCT<user_id: STRING, log_user_id: STRING, is_internal_user: BOOLEAN, ignore_usage: BOOLEAN>"
TIMING = "STRUCT<client_log_timestamp: BIGINT, event_api_timestamp: BIGINT, log_timestamp: BIGINT>"
CLIENT = "STRUCT<client_type: STRING, traffic_type: STRING>"
COMMON = f"platform_id: BIGINT, user_info: {USER_INFO}, timing: {TIMING}, client_info: {CLIENT}"

INSERTION = (
    "STRUCT<insertion_id: STRING, content_id: STRING, position: BIGINT, retrieval_rank: BIGINT,"
    " retrieval_score: DOUBLE, properties: STRING>"
)
CART_ITEM = "STRUCT<content_id: STRING, quantity: BIGINT, amount_micros: BIGINT>"

USER = f"STRUCT<{COMMON}, properties: STRING>"
COHORT_MEMBERSHIP = f"STRUCT<{COMMON}, membership_id: STRING>"
VIEW = f"STRUCT<{COMMON}, view_id: STRING, session_id: STRING, name: STRING, content_id: STRING, user_agent: STRING>"
AUTO_VIEW = f"STRUCT<{COMMON}, auto_view_id: STRING, session_id: STRING>"
REQUEST = (
    f"STRUCT<{COMMON}, request_id: STRING, client_request_id: STRING, view_id: STRING, session_id: STRING,"
    f" search_query: STRING, user_agent: STRING, insertion: ARRAY<{INSERTION}>,"
    " insertion_matrix_headers: ARRAY<STRING>, insertion_matrix: ARRAY<ARRAY<STRING>>>"
)
DELIVERY_LOG = (
    f"STRUCT<platform_id: BIGINT, request: {REQUEST}, response: STRUCT<insertion: ARRAY<{INSERTION}>, paging_id: STRING>,"
    f" execution: STRUCT<execution_server: STRING, insertion: ARRAY<{INSERTION}>>>"
)
IMPRESSION = (
    f"STRUCT<{COMMON}, impression_id: STRING, insertion_id: STRING, request_id: STRING, view_id: STRING,"
    " session_id: STRING, content_id: STRING, properties: STRING>"
)
ACTION = (
    f"STRUCT<{COMMON}, action_id: STRING, impression_id: STRING, insertion_id: STRING, request_id: STRING,"
    " view_id: STRING, session_id: STRING, content_id: STRING, action_type: INT, custom_action_type: STRING,"
    f" cart: ARRAY<{CART_ITEM}>, properties: STRING>"
)
DIAGNOSTICS = f"STRUCT<{COMMON}, payload: STRING>"
SESSION = f"STRUCT<{COMMON}, session_id: STRING, start_ms: BIGINT>"
SESSION_PROFILE = f"STRUCT<{COMMON}, session_id: STRING, properties: STRING>"

#: Record types of a log batch, by the name of the array that holds them.
RECORDS = {
    "user": USER,
    "cohort_membership": COHORT_MEMBERSHIP,
    "view": VIEW,
    "auto_view": AUTO_VIEW,
    "delivery_log": DELIVERY_LOG,
    "impression": IMPRESSION,
    "action": ACTION,
    "diagnostics": DIAGNOSTICS,
    "session": SESSION,
    "session_profile": SESSION_PROFILE,
}
LOG_REQUEST = ", ".join(
    [f"platform_id BIGINT, user_info {USER_INFO}, timing {TIMING}, client_info {CLIENT}"]
    + [f"{name} ARRAY<{kind}>" for name, kind in RECORDS.items()]
)
