"""Formats, patterns and limits that results depend on."""

# --- prompt section labels -------------------------------------------------
SYSTEM_LABEL = "[系统指令]"
HISTORY_LABEL = "[对话历史]"
CURRENT_LABEL = "[当前问题]"
TOOL_RESULT_LABEL = "[工具结果]"

# --- limits ----------------------------------------------------------------
MAX_REPLAY_MESSAGES = 20
MAX_PROMPT_CHARS = 12000
SESSION_TOKEN_LIMIT = 80000
SESSION_TTL_DAYS = 7
MAX_CONCURRENT = 5
MAX_PAGE_ROWS = 200
MARKER_HOLDBACK = 15
TOOL_DESCRIPTION_CHARS = 120
DEFAULT_TEMPERATURE = 0.8
DEFAULT_TOP_P = 0.95
DEFAULT_WEB_SEARCH = "disabled"

# --- markers ---------------------------------------------------------------
THINK_OPEN = "<think>"
THINK_CLOSE = "</think>"
TOOL_OPEN = "<tool_call>"
TOOL_CLOSE = "</tool_call>"
CALLS_OPEN = "<function_calls>"
CALLS_CLOSE = "</function_calls>"
RESULT_OPEN = "<tool_result>"
RESULT_CLOSE = "</tool_result>"

# White space as the chat clients trim it.
WHITESPACE = (
    "\t\n\x0b\x0c\r \u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000\ufeff"
)
WS = r"[\s\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff]"

# --- patterns of the tool-call dialects -------------------------------------
THINK_BLOCK = r"<think>[\s\S]*?</think>"
TOOL_BLOCK = r"<tool_call>([\s\S]*?)</tool_call>"
CALLS_BLOCK = r"<function_calls>([\s\S]*?)</function_calls>"
INVOKE = r'<invoke name="([^"]+)">([\s\S]*?)</invoke>'
INVOKE_PARAM = r'<parameter name="([^"]+)">([\s\S]*?)</parameter>'
NAME_ELEMENT = r"<name>([^<\n]+?)</name>"
NAME_EQUALS = r"<name=([^<>\n/]+)"
NAME_PARAM = (
    rf'<param(?:{WS}+name="([^"]+)")?(?:{WS}+key="([^"]+)")?[^>]*>([\s\S]*?)</param>'
)
TOOL_NAME = r"<tool_name>([^<]+)</tool_name>"
TOOL_NAME_ARG = rf"<arg_key>([^<]+)</arg_key>{WS}*<arg_value>([\s\S]*?)</arg_value>"
FUNCTION = r"<function=([^>\n]+)>"
FUNCTION_PARAM = r"<parameter=([^>\n]+)>([\s\S]*?)(?:</parameter>|\n</function>|\z)"
TAG_NAME = r"^<([a-zA-Z_][a-zA-Z0-9_]*)>"
TAG_ELEMENT = r"<([a-zA-Z_][a-zA-Z0-9_]*)>([\s\S]*?)</\1>"

# --- upstream outcomes: HTTP status -> class, message ------------------------
# "{service}" and "{status}" are filled in by the operator.
OUTCOMES = {
    400: ("bad_request", "{service} 请求参数错误"),
    401: ("auth", "登录已过期，请重新登录"),
    403: ("auth", "登录已过期，请重新登录"),
    451: ("banned_temporary", "账号已被临时封禁"),
    461: ("banned_permanent", "账号已被永久封禁"),
    429: ("rate_limit", "请求过于频繁，请稍后重试"),
    503: ("server_error", "服务暂时不可用，请稍后重试"),
}
OTHER_OUTCOME = ("unknown", "{service} API 错误: {status}")
CLIENT_STATUS = {
    "auth": 401,
    "banned_temporary": 403,
    "banned_permanent": 403,
    "rate_limit": 429,
}
OTHER_CLIENT_STATUS = 502
BAN_STATUS = {"banned_temporary": "TEMPORARY", "banned_permanent": "PERMANENT"}
