"""Schemas of the tables that flow between the stages."""

PAGES = "job_id string, pdf_filename string, page_idx int, width double, height double, direct_text string"
CANDIDATES = "job_id string, pdf_filename string, page_idx int, scale double, method string, psm int, attempt_no int, raw_text string, confidence double"
PAGE_HEADERS = "job_id string, pdf_filename string, page_idx int, header string"
GROUPS = "job_id string, pdf_filename string, group_idx int, start_page int, end_page int, header string"
RECORDS = (
    "timestamp timestamp, pdf_filename string, page_number int, header_extracted string, confidence_score int, ocr_method string, "
    "processing_time_ms double, render_scale double, status string, error_message string, quality_flags string, split_group string, output_filename string"
)
JOB_METRICS = (
    "job_id string, filename string, started_at timestamp, completed_at timestamp, processing_time_seconds double, total_pages int, processed_pages int, "
    "avg_time_per_page_seconds double, ocr_attempts int, ocr_successful int, success_rate double, best_score int, api_calls int, api_success int, "
    "api_failures int, api_success_rate double, errors_count int, errors array<string>"
)
BINARY_FILES = "path string, modificationTime timestamp, length long, content binary"
