"""The engine's tables. Order is always a column: msg_pos, part_pos, seq."""

SESSIONS = "session_id string, title string, directory string, created_at bigint, updated_at bigint, source_kind string, project_id string, source_version string, task_type string, model string, provider string"
USAGE = "struct<cache_read:bigint,cache_write:bigint,input:bigint,output:bigint,reasoning:bigint>"
MESSAGES = f"session_id string, msg_pos bigint, id string, role string, time bigint, completed_time bigint, turn_id string, origin string, semantics_kind string, visibility string, model string, provider string, mode string, agent string, finish string, usage {USAGE}, cwd string, summary_title string, summary_body string, json_ok boolean"
PARTS = "session_id string, msg_pos bigint, part_pos bigint, id string, kind string, time bigint, text string, call_id string, tool_name string, status string, input string, input_kind string, output string, error string, tool_end_time bigint, mime string, url string, size_bytes bigint, step_finish_reason string, json_ok boolean"
REGISTRY = "source_id string, target_id string, variant string, title string, cwd string, imported_at bigint, first_imported_at bigint, last_mode string, source_message_count bigint, source_updated_at bigint, turn_digests array<string>, digest_version int, event_count bigint, warning_count bigint, conflict_reason string, conflict_turn bigint"
WARNINGS = "session_id string, code string, severity string, where string, detail map<string,string>"
HEADERS = "session_id string, target_id string, version int, created_at bigint, cwd string, delegation_depth int"
