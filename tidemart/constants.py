"""Values that are part of the data contract."""

# Column names of the change-record envelope.
RECORD_ID = "_airbyte_ab_id"
EMITTED_AT = "_airbyte_emitted_at"
PAYLOAD = "_airbyte_data"

# Column names of versioned (SCD-2) tables.
VALID_FROM = "dbt_valid_from"
VALID_TO = "dbt_valid_to"

# Column names added while uniting tables and ingesting files.
SOURCE_RELATION = "_dbt_source_relation"
FILE_NAME = "metadata_filename"
FILE_ROW_NUMBER = "metadata_file_row_number"
FILE_LAST_MODIFIED = "metadata_file_last_modified"
COPIED_AT = "_dbt_copied_at"

# Fixed value: stands for NULL inside a surrogate key.
KEY_NULL = "_dbt_utils_surrogate_key_null_"

# Upper end of an open version, default date key of a payment.
OPEN_END = "9999-12-31 00:00:00"
UNKNOWN_DATE_ID = 19000101
