"""Schemas of the stored tables."""

JOBS = (
    "external_id string, title string, company string, company_normalized string, location string, location_country string, work_arrangement string, "
    "is_remote string, description string, description_snippet string, salary_min double, salary_max double, salary_range string, source_url string, "
    "apply_url string, source_name string, category string, seniority string, seniority_confidence string, lifecycle_status string, "
    "last_lifecycle_check date, last_lifecycle_verdict string, keyword_score int, fit_score int, llm_confidence int, keywords_matched string, "
    "llm_classification string, llm_provider string, llm_reasoning string, location_confidence string, salary_confidence string, remote_confidence string, "
    "enrichment_source string, enrichment_date string, vendors_mentioned string, date_posted string, field_sources string, first_seen_date date, "
    "last_seen_date date, is_active int, archived_date date, days_active int, wp_post_id long, raw_data string"
)
RUN_LOG = "run_ts timestamp, source_counts map<string,bigint>, published long, errors array<string>, duration_seconds double"
RETRY_QUEUE = "external_id string, job_json string, attempts int, last_attempt timestamp"
STATS = "stat_date date, stat_type string, stat_key string, stat_value long"
SLUG_STATUS = "ats string, slug string, status string, last_checked date, jobs_found int"
OBSERVATIONS = "external_id string, field string, seq int, source string, value string, confidence double"
SNAPSHOT_BOARDS = "ats string, slug string"
SNAPSHOT_JOBS = "ats string, slug string, jid string"
