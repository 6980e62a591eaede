"""Declared schemas of the tables the jobs exchange."""

RAW_TICKET = (
    "id bigint, subject string, body string, answer string, queue string, priority string, "
    "language string, type string, created_at timestamp_ntz"
)

ENRICHED = RAW_TICKET + (
    ", urgency_level string, body_clean string, answer_clean string, body_length int, "
    "answer_length int, response_ratio double, has_network int, has_printer int, has_security int, "
    "has_hardware int, has_software int, refined_queue string"
)

PREDICTION_LOG = (
    "id bigint, input_text string, predicted_queue string, predicted_urgency string, response string, "
    "language string, confidence_queue double, confidence_urgency double, created_at timestamp_ntz, "
    "feedback_queue string, feedback_urgency string, feedback_at timestamp_ntz"
)

RAG_DOC = (
    "id string, title string, content string, embedding array<float>, "
    "metadata struct<refined_queue:string,urgency_level:string,language:string>"
)

EMBEDDING_CACHE = (
    "text_hash string, model_name string, text_content string, embedding array<float>, "
    "created_at timestamp_ntz"
)

DRIFT_LOG = "check_date timestamp_ntz, drift_detected boolean, drift_share double, report_path string"

RUN_RECORD = (
    "run_id string, dataset string, metrics struct<f1_queue:double,f1_urgency:double>, "
    "params map<string,string>, status string, reason string"
)
