"""Word lists, patterns' words, formats and wording that outputs depend on.

Everything here must stay exactly as it is for results to be right: the cleaned
text, the summary schema and the rendered prompts are compared and trained on
character by character. Nothing in this file is logic.
"""

# Markers that start quoted history in a mail body.
QUOTE_INTRO_START = "On "
QUOTE_INTRO_END = "wrote:"
QUOTE_HEADER_LABELS = ("From", "Sent", "Subject")
QUOTE_TITLE = "Original Message"

# Line beginnings that start a signature.
SIGNATURE_MARKERS = ("--", "Thanks", "Regards", "Best", "Sincerely", "Thank you")

# Characters taken off the end of a link.
URL_TAIL = ".,)"

# Length limits.
BODY_LIMIT = 4000
SEQUENCE_LIMIT = 1536
CUT_MARK = " ..."

# The five labels of a summary, in order.
SUMMARY_LABELS = (
    "Purpose",
    "Key details",
    "Action needed",
    "Deadline/Date",
    "Important context/links",
)
MISSING_VALUE = "N/A"

# Task names and request defaults.
TASKS = ("summarize", "reply", "rewrite", "phishing", "spam", "categorize", "attachment")
TASK_WITHOUT_INDEX = "search"
SEARCH_ERROR = (
    "Smart search requires an embedding index; "
    "build one with a sentence-transformer and FAISS first."
)
DEFAULT_TONE = "neutral"
DEFAULT_STYLE = "professional"
DEFAULT_LENGTH = "short"
DEFAULT_SUBJECT = "(no subject)"
NO_ATTACHMENTS = "(none provided)"
DEFAULT_CATEGORIES = (
    "Billing",
    "Sales",
    "Support",
    "HR",
    "Legal",
    "Engineering",
    "Scheduling",
    "Other",
)

# Fields and labels of the classifying tasks' replies.
REPLY_FIELDS = {
    "phishing": ("label", "reason"),
    "spam": ("label", "reason"),
    "categorize": ("category", "reason"),
    "attachment": ("summary", "checks"),
}
REPLY_LABELS = {"phishing": ("phishing", "benign"), "spam": ("spam", "ham")}

# Output budgets in tokens.
LONG_BUDGET = 256
SHORT_BUDGET = 160
CHAT_TEACHER_BUDGET = 140

# Sampling settings for a model client; the top-p holds for all but the strict teacher.
TEMPERATURE = 0.2
TOP_P = 0.9

# Batch arithmetic of the training run.
BATCH_SIZE = 1
ACCUMULATION_STEPS = 16
EPOCHS = 2
SEED = 42

# Wording of the summary prompt.
SUMMARY_SYSTEM = """\
You are an email summarization assistant. Summarize the user's email into EXACTLY 5 lines using this schema:
1) Purpose: ...
2) Key details: ...
3) Action needed: ...
4) Deadline/Date: ...
5) Important context/links: ...

Rules:
- Always output exactly 5 lines, no bullets beyond the numbered labels.
- Do not add blank lines or commentary.
- If information is missing, write "N/A" after the label.
- Keep lines concise but specific."""
SUMMARY_USER = "Summarize the following email.\n\nSubject: {subject}\nBody:\n{body}"

# Wording of the chat teacher's summary prompt.
CHAT_TEACHER_SYSTEM = """\
You summarize emails. Output EXACTLY 5 lines with this schema:
1) Purpose: ...
2) Key details: ...
3) Action needed: ...
4) Deadline/Date: ...
5) Important context/links: ...
Rules:
- EXACTLY 5 lines only (no extra text, no blank lines).
- Be faithful to the email.
- Include names, numbers, and links when present.
"""
CHAT_TEACHER_USER = "Subject: {subject}\n\nEmail:\n{body}"

# Wording of the correction turns.
SERVING_CORRECTION = (
    "Output EXACTLY 5 lines following the schema. "
    "Fix formatting now without adding explanation."
)
TEACHER_CORRECTION = (
    "The previous answer was invalid. Output EXACTLY 5 lines with the specified labels."
)
CHAT_TEACHER_CORRECTION = (
    "Fix ONLY the format. Output EXACTLY 5 lines in the required schema. No extra text."
)

# Wording of the other tasks' system prompts.
TASK_SYSTEM = {
    "reply": "You draft concise, action-aware email replies. Keep it polite, factual, and specific. No bullet lists; short paragraphs only. Include commitments, timelines, and links if present. Stay under ~150 words unless the user asks for long.",
    "rewrite": "You rewrite emails to match the requested style and keep all key facts, numbers, names, dates, and links. No added content. Keep it concise and readable.",
    "phishing": "You are a phishing detector. Output a label and a short reason. Prioritize links, urgency, credential requests, spoofing, or mismatched senders.\nFormat:\nlabel: phishing|benign\nreason: <one short sentence>",
    "spam": "You are a spam classifier. Output a label and a brief reason.\nFormat:\nlabel: spam|ham\nreason: <one short sentence>",
    "categorize": "You pick exactly one category from the provided list and explain briefly. Keep to one line for the category and one for the reason.\nFormat:\ncategory: <label>\nreason: <one short sentence>",
    "attachment": "You summarize attachment metadata and what to check. Do not invent file contents. Mention file names, types, and any safety checks (links, macros) the reader should perform.\nFormat:\nsummary: <concise summary>\nchecks: <one short sentence of what to verify>",
}

# Formats of the other tasks' user turns.
TASK_USER = {
    "reply": "Subject: {subject}\nOriginal email:\n{body}\n\nConstraints: tone={tone}; length={length}.",
    "rewrite": "Subject: {subject}\nOriginal email:\n{body}\n\nRewrite style: {style}.",
    "phishing": "Subject: {subject}\nEmail:\n{body}\n\nDecide if phishing or benign; follow the required format.",
    "spam": "Subject: {subject}\nEmail:\n{body}\n\nClassify as spam or ham; follow the required format.",
    "categorize": "Subject: {subject}\nEmail:\n{body}\n\nChoose one category from: {categories}.",
    "attachment": "Subject: {subject}\nEmail:\n{body}\n\nAttachments: {attachments}\nSummarize metadata and safety checks; do not invent contents.",
}

# The sample message and the corpus name.
CORPUS_NAME = "enron"
SAMPLE_BODY = (
    "Hi team,\n\nPlease review the attached report and share feedback by Friday."
    " Also note the updated dashboard link: https://example.com/dashboard\n\nThanks!"
)
SAMPLE_LIMIT = 3
