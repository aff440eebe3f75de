"""Names, word lists, templates and markers.

Everything below has to equal the values other tools write or expect, so it is
stated plainly and kept together.
"""

# --- fixed values: the event table ------------------------------------------------
EVENT_COLUMNS = ["_ID", "EVENT", "STATE", "STATUS", "JOB_ID", "TIME", "METADATA"]
STATES = ["Finished", "Started"]
STATUSES = ["running", "assigned", "finished"]
EVENTS = ["JobExecution", "JobAllocation", "FileRead", "FileWrite", "FileTransfer"]
FILE_EVENTS = ["FileRead", "FileWrite", "FileTransfer"]
SAMPLE_ORDER = ["FileRead", "FileTransfer", "FileWrite", "JobAllocation", "JobExecution"]

EVENT_KEYS = {
    "JobAllocation": ["grid_cpu_util", "grid_storage_util", "host", "site", "site_cpu_util", "site_storage_util"],
    "JobExecution": [
        "cores", "cost", "duration", "file_transfer_queue_time", "flops", "grid_cpu_util", "host",
        "resource_waiting_queue_time", "retries", "site", "site_cpu_util", "speed", "total_io_read_time",
        "total_queue_time",
    ],
    "FileRead": ["disk", "disk_read_bw", "duration", "file", "host", "site", "size"],
    "FileWrite": [
        "disk", "disk_write_bw", "duration", "file", "grid_storage_util", "host", "site", "site_storage_util", "size",
    ],
    "FileTransfer": [
        "bandwidth", "destination_site", "duration", "file", "grid_storage_util", "latency", "link_load",
        "site_storage_util", "size", "source_site",
    ],
}
TEXT_KEYS = ["destination_site", "disk", "file", "host", "site", "source_site"]

# --- fixed values: tools ----------------------------------------------------------
CHECK_TOOLS = {
    "check_JobAllocation": ["JobAllocation"],
    "check_FileTransfer": ["FileTransfer"],
    "check_FileRead": ["FileRead"],
    "check_FileWrite": ["FileWrite"],
    "check_JobExecution": ["JobExecution"],
    "check_All": SAMPLE_ORDER,
}
CHECK_ALL = "check_All"
SQL_TOOL = "execute_sql"
NO_INPUT = "NO_INPUT"
TOOL_NAMES = [*CHECK_TOOLS, SQL_TOOL]

ROUTING_WORDS = {
    "check_JobAllocation": ["allocation", "assignment", "placement", "resource assignment"],
    "check_JobExecution": ["execution", "processing", "compute", "running", "queue", "speed", "flops"],
    "check_FileTransfer": ["transfer", "migration", "movement", "sent", "delivered", "source", "destination"],
    "check_FileRead": ["read", "retrieve", "input", "opened file", "disk read"],
    "check_FileWrite": ["write", "save", "output", "stored file", "disk write"],
}

# --- fixed values: question templates ---------------------------------------------
# (question, names the event type?, column alias of the SQL; None = the key itself)
LOOKUP_TEMPLATES = {
    "JobAllocation": [
        ("For job {jobid}, what is the {field1} in the JobAllocation record?", True, "value"),
        ("For job {jobid}, what is the recorded {field1}?", False, None),
        ("For the allocation of job {jobid}, show the {field1} from the metadata.", True, None),
    ],
    "FileTransfer": [
        ("What is the {field1} of job {jobid} in the file transfer event?", True, None),
        ("What is the {field1} of job {jobid}?", False, None),
        ("For job {jobid}, what is the {field1} during transfer?", True, None),
    ],
    "FileRead": [
        ("What is the {field1} of job {jobid} in the file reading event?", True, None),
        ("What is the {field1} of job {jobid}?", False, None),
        ("For job {jobid}, what is the {field1} during reading task?", True, None),
    ],
    "FileWrite": [
        ("What is the {field1} of job {jobid} in the file writing event?", True, None),
        ("What is the {field1} of job {jobid}?", False, None),
        ("For job {jobid}, what is the {field1} during writing task?", True, None),
    ],
    "JobExecution": [
        ("For job {jobid}, what is the {field1} in the JobExecution record?", True, None),
        ("For job {jobid}, what is the recorded {field1}?", False, None),
        ("During execution of job {jobid}, what is the {field1}?", True, None),
    ],
}
SITE_QUESTIONS = [
    "What is the allocation job id at site {site}?",
    "At site {site}, what is the allocated job id?",
    "List the allocated JOB_IDs for JobAllocation events at site {site}.",
    "Which job IDs were allocated at {site} site?",
]
SITE_SQL = (
    "SELECT DISTINCT JOB_ID FROM EVENTS WHERE EVENT = 'JobAllocation' "
    "AND json_extract(METADATA, '$.site') = '{site}';"
)
SITE_ANSWER = "At site '{site}', the allocated job id is '{ans}'."
LOOKUP_ANSWER = (
    "For job '{jobid}', the '{field1}' is related to '{field2}' in the {event} record, and the value is '{ans}'."
)
EVENT_WORD = {
    "JobAllocation": "allocation",
    "FileTransfer": "transfer",
    "FileRead": "read",
    "FileWrite": "write",
    "JobExecution": "execution",
}
REASON_CLEAR = "According to '{word}' in the question, check_{event} should be used.\n"
REASON_AMBIGUOUS = "The event type is not clear, so check_All should be used.\n"
REASON_DISTINCT = "Need filters, json_extract, and DISTINCT.\n"

# --- fixed values: phrases for the keys -------------------------------------------
SYNONYMS = {
    "JobAllocation": {
        "grid_cpu_util": [
            "grid cpu utilization", "grid cpu usage", "grid cpu status", "grid_cpu_util", "grid cpu resource",
        ],
        "grid_storage_util": [
            "grid space utilization", "grid space usage", "grid space status", "grid_storage", "grid storage",
        ],
        "site_cpu_util": [
            "site cpu utilization", "site cpu usage", "site cpu status", "site_cpu_util", "site cpu resource",
        ],
        "site_storage_util": [
            "site space utilization", "site space usage", "site space status", "site_storage", "site storage",
        ],
        "site": ["site name", "site"],
        "host": ["host name", "host"],
    },
    "FileTransfer": {
        "duration": ["transferring time", "transfer time", "time for file transfer", "file transfer duration"],
        "bandwidth": ["bandwidth", "band width", "bands width"],
        "destination_site": ["destination site", "target site", "receiving site", "ending site", "destination_site"],
        "source_site": ["source site", "start site", "source_site", "sending site"],
        "latency": ["latency", "latacy", "latent time"],
    },
    "FileRead": {
        "duration": ["file reading time", "read time", "time for file reading", "file read duration"],
        "disk": ["disk name", "file disk"],
        "disk_read_bw": ["read band width", "file read bandwidth", "disk reading band width", "disk read bandwidth"],
    },
    "FileWrite": {
        "duration": ["file writing time", "write time", "time for file writing", "file write duration"],
        "disk": ["disk name", "file disk"],
        "disk_write_bw": ["write bandwidth", "file write bandwidth", "disk writing band width", "disk write bandwidth"],
    },
    "JobExecution": {
        "duration": ["execution time", "run time", "duration"],
        "total_queue_time": ["queue time", "total queue time"],
        "speed": ["speed", "cpu speed"],
        "flops": ["flops", "compute flops"],
    },
}

# --- fixed values: markers in generated answers -----------------------------------
SQL_ERROR = "__SQL_ERROR__"
ANSWER = "__ANSWER__"
NULL_RESULT = "__NULL_RESULT__"
INCOMPLETE_RESULT = "__INCOMPLETE_RESULT__"
UNRECOGNISED = "__INCOMPLETE_RESULT__ Answer format is not recognized."

QUESTION_KEYS = ["user_question", "reason_check", "check_tool"]
SQL_KEYS = ["reason_sql", "sql"]
RESULT_LIST_KEYS = ["rows", "data", "result", "results"]
ERROR_TEXTS = [
    "no such column", "no such table", "syntax error", "operationalerror", "sqlite error", "ambiguous column",
    "misuse of aggregate", "near ",
]

# --- fixed values: markers in rendered conversations ------------------------------
HEADER_START = "<|start_header_id|>"
HEADER_END = "<|end_header_id|>"
END_OF_TURN = "<|eot_id|>"
SHORT_END_OF_TURN = "<eot_id>"
TOOL_RESPONSE_START = "<TOOL_RESPONSE>"
TOOL_RESPONSE_END = "</TOOL_RESPONSE>"
TOOLCALL_START = "<TOOLCALL>"
TOOLS_START = "<TOOLS>"  # own form, as is the rest of the rendered header
TOOLS_END = "</TOOLS>"
TOOLCALL_END = "</TOOLCALL>"
PLACEHOLDER = "▁▁"
IGNORE_LABEL = -100
WEIGHT_NORMAL = 1.0
WEIGHT_JSON_CALL = 2.0
WEIGHT_JSON_MARK = 20.0
JSON_CALL_START = "json_extract(METADATA, '$."
JSON_MARK = "$."
LENGTH_STEP = 1024
LENGTH_CAP = 8192

# --- fixed values: evaluation -----------------------------------------------------
MAX_ROUNDS = 6
SCORE_TOOL = 0.3
SCORE_SQL = 0.4
SCORE_ANSWER = 0.3

# White space removed by trimming, as Python's str.strip does.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0            "
    "    　"
)

SYSTEM_MESSAGE = "Answer questions about the event log. Call tools when you need to look at the data."

# --- fixed values: outcomes of a conversation, in the order in which they are looked for ---
SUCCESS = "SUCCESS"
UNFINISHED = "TRANSCRIPT_UNFINISHED"
OUTCOMES = [
    "HTTP_ERROR", "VLLM_RESPONSE_PARSE_ERROR", "UNEXPECTED_ERROR", "GENERATION_LENGTH_CUTOFF", "TOOLCALL_TAG_UNCLOSED",
    "TOOLCALL_JSON_ERROR", "EMPTY_TOOLCALL", "TOOLCALL_NOT_DICT", "EMPTY_FINAL_ANSWER", "TOOLCALL_MISSING_NAME",
    "REPEATED_TOOLCALL_LOOP", "UNKNOWN_CHECK_TOOL", "UNKNOWN_TOOL", "SQL_ARGUMENT_ERROR", "SQL_EXECUTION_ERROR",
    "SQL_TOOL_RUNTIME_ERROR", "SQL_HALLUCINATION_OR_EXECUTION_ERROR", "SQL_EMPTY_RESULT", SUCCESS,
]
CALL_ERRORS = {
    "http_error": "HTTP_ERROR",
    "parse_error": "VLLM_RESPONSE_PARSE_ERROR",
    "unexpected_error": "UNEXPECTED_ERROR",
}
TOOL_ERRORS = {"sql_error": "SQL_EXECUTION_ERROR", "runtime_error": "SQL_TOOL_RUNTIME_ERROR"}

# --- fixed values: tools a draw picks from -----------------------------------------
EVENT_CHOICES = [
    "check_JobAllocation", "check_JobExecution", "check_FileRead", "check_FileWrite", "check_FileTransfer", "check_All",
]

# --- messages of errors (own wording) ----------------------------------------------
ERROR_MESSAGES = {
    "HTTP_ERROR": "the call to the model failed",
    "VLLM_RESPONSE_PARSE_ERROR": "the model's response could not be read",
    "UNEXPECTED_ERROR": "the call ended in an unexpected way",
    "GENERATION_LENGTH_CUTOFF": "the output was cut off at the greatest number of tokens",
    "EMPTY_FINAL_ANSWER": "there is neither a tool call nor an answer",
    "TOOLCALL_TAG_UNCLOSED": "a tool call is opened and never closed",
    "TOOLCALL_JSON_ERROR": "the tool call is not valid JSON",
    "TOOLCALL_NOT_LIST": "the tool call is not a list",
    "EMPTY_TOOLCALL": "the list of tool calls is empty",
    "TOOLCALL_NOT_DICT": "the first tool call is not an object",
    "TOOLCALL_MISSING_NAME": "the tool call has no name",
    "REPEATED_TOOLCALL_LOOP": "the same tool call was made before",
    "UNKNOWN_CHECK_TOOL": "there is no such check tool",
    "UNKNOWN_TOOL": "there is no such tool",
    "SQL_ARGUMENT_ERROR": "the SQL tool was called without SQL",
    "SQL_HALLUCINATION_OR_EXECUTION_ERROR": "the result looks like an error of the database",
    "SQL_EMPTY_RESULT": "the SQL ran and returned nothing",
    "MAX_ROUNDS_EXCEEDED": "no answer within the allowed rounds",
}
