"""Fixed column names and schemas (as DDL text) shared by all operators."""

RECORD = "record"
FIELD = "field_name"
VALUE = "value"
EVENT = "redcap_event_name"
INSTRUMENT = "redcap_repeat_instrument"
INSTANCE = "redcap_repeat_instance"

EAV_COLUMNS = [RECORD, FIELD, VALUE, EVENT]
FLAT_KEYS = ["record_id", EVENT, INSTRUMENT, INSTANCE]


def _fields(**columns: str) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in columns.items())


EAV_SCHEMA = _fields(
    record="string",
    field_name="string",
    value="string",
    redcap_event_name="string",
    redcap_repeat_instrument="string",
    redcap_repeat_instance="int",
)
DICT_SCHEMA = _fields(
    field_name="string",
    form_name="string",
    field_type="string",
    select_choices_or_calculations="string",
)
FORM_EVENT_SCHEMA = _fields(form="string", unique_event_name="string")
LEDGER_SCHEMA = _fields(
    ledger="string", key="string", processed_at="timestamp", metadata="map<string,string>"
)
ERROR_SCHEMA = _fields(datetime="timestamp", mrn="string", error="string", attempt="string")

# One alert message as it arrives on the wire (snake_case spelling).
ALERT_SCHEMA = _fields(
    id="string",
    is_watched="boolean",
    applet_id="string",
    applet_name="string",
    version="string",
    secret_id="string",
    activity_id="string",
    activity_item_id="string",
    message="string",
    created_at="string",
    answer_id="string",
    encryption="struct<base:string,prime:string,account_id:string,public_key:string>",
    workspace="string",
    respondent_id="string",
    subject_id="string",
    type="string",
)

# One respondent with its per-application details.
RESPONDENT_SCHEMA = _fields(
    status="string",
    lastSeen="string",
    details="array<struct<appletId:string,respondentSecretId:string,subjectId:string>>",
)

# One decrypted activity answer; `answer[i].value` is any JSON value, kept as text.
ANSWER_SCHEMA = _fields(
    submitId="string",
    version="string",
    startDatetime="string",
    endDatetime="string",
    respondentSecretId="string",
    sourceSecretId="string",
    items=(
        "array<struct<id:string,name:string,question:struct<en:string>,responseType:string,"
        "responseValues:struct<options:array<struct<text:string,value:int,score:int>>>>>"
    ),
    answer="array<struct<value:string>>",
)

# A data-entry trigger.
TRIGGER_SCHEMA = _fields(
    project_id="int",
    instrument="string",
    record="string",
    redcap_event_name="string",
    redcap_repeat_instance="string",
    redcap_repeat_instrument="string",
    flag="string",
)
