"""The student record: one instance of ``FeatureSpec``, its message fields and its codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.casts import missing_to_null, strip
from riskloom.operators.dictionary import encode_labels
from riskloom.spec import FeatureSpec

# Field names of the record, in wire order, and the roles they play.
IDENTITY_FIELDS = ("Student ID", "First Name", "Last Name")

INTEGER_FIELDS = (
    "Marital status",
    "Application mode",
    "Application order",
    "Course",
    "Daytime/evening attendance",
    "Previous qualification",
    "Nacionality",
    "Mother's qualification",
    "Father's qualification",
    "Mother's occupation",
    "Father's occupation",
    "Displaced",
    "Educational special needs",
    "Debtor",
    "Tuition fees up to date",
    "Gender",
    "Scholarship holder",
    "Age at enrollment",
    "International",
)

SEMESTERS = ("1st", "2nd")
UNIT_COUNTS = ("credited", "enrolled", "evaluations", "approved", "grade", "without evaluations")
DOUBLE_FIELDS = tuple(f"Curricular units {s} sem ({u})" for s in SEMESTERS for u in UNIT_COUNTS) + (
    "Unemployment rate",
    "Inflation rate",
    "GDP",
)

TARGET = "Target"
LABELS = ("Dropout", "Enrolled", "Graduate")

RENAMES = {
    "Nacionality": "Nationality",
    "Mother's qualification": "Mother_qualification",
    "Father's qualification": "Father_qualification",
    "Mother's occupation": "Mother_occupation",
    "Father's occupation": "Father_occupation",
    "Age at enrollment": "Age",
}

CATEGORICAL = (
    "Marital_status",
    "Application_mode",
    "Course",
    "Daytime/evening_attendance",
    "Previous_qualification",
    "Mother_qualification",
    "Father_qualification",
    "Mother_occupation",
    "Father_occupation",
    "Displaced",
    "Debtor",
    "Tuition_fees_up_to_date",
    "Gender",
    "Scholarship_holder",
)
NUMERIC = ("Age", "Application_order", "avg_credited", "avg_evaluations", "avg_approved", "avg_without_evaluations")

# What chi-square and rank correlation screening removed.
SCREENED_CATEGORICAL = ("Nationality", "International", "Educational_special_needs")
SCREENED_NUMERIC = ("Unemployment_rate", "Inflation_rate", "GDP", "avg_enrolled", "avg_grade")

TOPIC_BASE = "external_dataset"
TOPIC_LABELLED = "manual_dataset_with_target"
TOPIC_UNLABELLED = "manual_dataset_without_target"
TOPIC_SCORES = "predicted_manual_dataset"
SCORE_FIELDS = ("student_id", "first_name", "last_name", "dropout_probability")


def _unit_pairs() -> dict[str, tuple[str, str]]:
    names = {u: u.replace(" ", "_") for u in UNIT_COUNTS}
    return {f"avg_{n}": tuple(f"Curricular_units_{s}_sem_{n}" for s in SEMESTERS) for n in names.values()}


STUDENT_SPEC = FeatureSpec(
    keys=IDENTITY_FIELDS,
    target=TARGET,
    label_order=LABELS,
    positive_label="Graduate",
    dropped_labels=("Enrolled",),
    integer_fields=INTEGER_FIELDS,
    double_fields=DOUBLE_FIELDS,
    renames=RENAMES,
    drops=SCREENED_CATEGORICAL + SCREENED_NUMERIC,
    drop_patterns=("Curricular_units",),
    pairs=_unit_pairs(),
    categorical=CATEGORICAL,
    numeric=NUMERIC,
    contradictions=("avg_approved = 0 AND Target = 'Graduate'",),
)


def risk_scores(scored: DataFrame) -> DataFrame:
    """Scores under their wire names. The risk is that of dropping out, the negative label."""
    names = dict(zip(("Student_ID", "First_Name", "Last_Name", "p_negative"), SCORE_FIELDS))
    return scored.select(*[F.col(column).alias(field) for column, field in names.items()])


# The answers of the entry form, each list in code order from 1.
PARENT_QUALIFICATIONS = (
    "Secondary Education—12th Year of Schooling or Equivalent",
    "Higher Education—bachelor's degree",
    "Higher Education—degree",
    "Higher Education—master's degree",
    "Higher Education—doctorate",
    "Frequency of Higher Education",
    "12th Year of Schooling—not completed",
    "11th Year of Schooling—not completed",
    "7th Year (Old)",
    "Other—11th Year of Schooling",
    "2nd year complementary high school course",
    "10th Year of Schooling",
    "General commerce course",
    "Basic Education 3rd Cycle (9th/10th/11th Year) or Equivalent",
    "Complementary High School Course",
    "Technical-professional course",
    "Complementary High School Course—not concluded",
    "7th year of schooling",
    "2nd cycle of the general high school course",
    "9th Year of Schooling—not completed",
    "8th year of schooling",
    "General Course of Administration and Commerce",
    "Supplementary Accounting and Administration",
    "Unknown",
    "Cannot read or write",
    "Can read without having a 4th year of schooling",
    "Basic education 1st cycle (4th/5th year) or equivalent",
    "Basic Education 2nd Cycle (6th/7th/8th Year) or equivalent",
    "Technological specialization course",
    "Higher education—degree (1st cycle)",
    "Specialized higher studies course",
    "Professional higher technical course",
    "Higher Education—master's degree (2nd cycle)",
    "Higher Education—doctorate (3rd cycle)",
)
PARENT_OCCUPATIONS = (
    "Student",
    "Representatives of the Legislative Power and Executive Bodies, Directors, Directors and Executive Managers",
    "Specialists in Intellectual and Scientific Activities",
    "Intermediate Level Technicians and Professions",
    "Administrative staff",
    "Personal Services, Security and Safety Workers, and Sellers",
    "Farmers and Skilled Workers in Agriculture, Fisheries, and Forestry",
    "Skilled Workers in Industry, Construction, and Craftsmen",
    "Installation and Machine Operators and Assembly Workers",
    "Unskilled Workers",
    "Armed Forces Professions",
    "Other Situation; 13—(blank)",
    "Armed Forces Officers",
    "Armed Forces Sergeants",
    "Other Armed Forces personnel",
    "Directors of administrative and commercial services",
    "Hotel, catering, trade, and other services directors",
    "Specialists in the physical sciences, mathematics, engineering, and related techniques",
    "Health professionals",
    "Teachers",
    "Specialists in finance, accounting, administrative organization, and public and commercial relations",
    "Intermediate level science and engineering technicians and professions",
    "Technicians and professionals of intermediate level of health",
    "Intermediate level technicians from legal, social, sports, cultural, and similar services",
    "Information and communication technology technicians",
    "Office workers, secretaries in general, and data processing operators",
    "Data, accounting, statistical, financial services, and registry-related operators",
    "Other administrative support staff",
    "Personal service workers",
    "Sellers",
    "Personal care workers and the like",
    "Protection and security services personnel",
    "Market-oriented farmers and skilled agricultural and animal production workers",
    "Farmers, livestock keepers, fishermen, hunters and gatherers, and subsistence",
    "Skilled construction workers and the like, except electricians",
    "Skilled workers in metallurgy, metalworking, and similar",
    "Skilled workers in electricity and electronics",
    "Workers in food processing, woodworking, and clothing and other industries and crafts",
    "Fixed plant and machine operators",
    "Assembly workers",
    "Vehicle drivers and mobile equipment operators",
    "Unskilled workers in agriculture, animal production, and fisheries and forestry",
    "Unskilled workers in extractive industry, construction, manufacturing, and transport",
    "Meal preparation assistants",
    "Street vendors (except food) and street service provider",
)
YES_NO = ("Yes", "No")
FORM_LISTS = {
    "Marital status": (
        "Single",
        "Married",
        "Widower",
        "Divorced",
        "Common-law marriage",
        "Legally separated",
    ),
    "Application mode": (
        "1st phase—general contingent",
        "Ordinance No. 612/93",
        "1st phase—special contingent (Azores Island)",
        "Holders of other higher courses",
        "Ordinance No. 854-B/99",
        "International student (bachelor)",
        "1st phase—special contingent (Madeira Island)",
        "2nd phase—general contingent",
        "3rd phase—general contingent",
        "Ordinance No. 533-A/99, item b2) (Different Plan)",
        "Ordinance No. 533-A/99, item b3 (Other Institution)",
        "Over 23 years old",
        "13Transfer",
        "Change in course",
        "Technological specialization diploma holders",
        "Change in institution/course",
        "Short cycle diploma holders",
        "Change in institution/course (International)",
    ),
    "Course": (
        "Biofuel Production Technologies",
        "Animation and Multimedia Design",
        "Social Service (evening attendance)",
        "Agronomy",
        "Communication Design",
        "Veterinary Nursing",
        "Informatics Engineering",
        "Equiniculture",
        "Management",
        "Social Service",
        "Tourism",
        "Nursing",
        "Oral Hygiene",
        "Advertising and Marketing Management",
        "Journalism and Communication",
        "Basic Education",
        "Management (evening attendance)",
    ),
    "Daytime/evening attendance": ("Evening", "Daytime"),
    "Previous qualification": (
        "Secondary education",
        "Higher education—bachelor's degree",
        "Higher education—degree",
        "Higher education—master's degree",
        "Higher education—doctorate",
        "Frequency of higher education",
        "12th year of schooling—not completed",
        "11th year of schooling—not completed",
        "Other—11th year of schooling",
        "10th year of schooling",
        "10th year of schooling—not completed",
        "Basic education 3rd cycle (9th/10th/11th year) or equivalent",
        "Basic education 2nd cycle (6th/7th/8th year) or equivalent",
        "Technological specialization course",
        "Higher education—degree (1st cycle)",
        "Professional higher technical course",
        "Higher education—master's degree (2nd cycle)",
    ),
    "Mother's qualification": PARENT_QUALIFICATIONS,
    "Father's qualification": PARENT_QUALIFICATIONS,
    "Mother's occupation": PARENT_OCCUPATIONS,
    "Father's occupation": PARENT_OCCUPATIONS,
    "Debtor": YES_NO,
    "Tuition fees up to date": YES_NO,
    "Gender": ("Female", "Male"),
    "Scholarship holder": YES_NO,
}
# Fields the form does not ask for.
FORM_CONSTANTS = {"Nacionality": "Portugal", "Educational special needs": "0", "International": "0"}


def form_to_records(answers: DataFrame) -> DataFrame:
    """Form answers as records: labels become codes (0 for no choice), "Displaced" is 1 for
    Yes and 0 for anything else, constant fields are filled in and identity text is trimmed."""
    coded = encode_labels(answers, FORM_LISTS).withColumns({c: F.col(f"`{c}`").cast("string") for c in FORM_LISTS})
    return coded.withColumns(
        {"Displaced": F.when(F.col("Displaced") == "Yes", "1").otherwise("0")}
        | {c: F.lit(v) for c, v in FORM_CONSTANTS.items()}
        | {c: F.trim(F.col(f"`{c}`")) for c in IDENTITY_FIELDS})


# The two-valued fields of the dataset, 0 for the first answer and 1 for the second.
BINARY_ANSWERS = {
    "Daytime/evening attendance": ("Evening", "Daytime"),
    "Displaced": ("No", "Yes"),
    "Debtor": ("No", "Yes"),
    "Tuition fees up to date": ("No", "Yes"),
    "Gender": ("Female", "Male"),
    "Scholarship holder": ("No", "Yes"),
}


def dataset_records(answers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Form answers in the codes of the dataset, and the answers that have none.

    Two-valued fields become 0 or 1, as records hold them, and others their place in the form's list. An answer that is missing is
    null. A record with an answer that the form does not offer is kept out of the first table, so that it is never
    taken for a code; the second has ``(Student ID, field, answer)`` for each of them.
    """
    lists = {c: labels for c, labels in FORM_LISTS.items() if c not in BINARY_ANSWERS}
    offered = {c: (labels, 1) for c, labels in lists.items()} | {c: (labels, 0) for c, labels in BINARY_ANSWERS.items()}

    def given(c: str) -> Column:
        return missing_to_null(F.col(f"`{c}`"))

    def code(c: str) -> Column:
        labels, first = offered[c]
        place = F.array_position(F.array(*[F.lit(v) for v in labels]), strip(given(c)))
        return F.when(place > 0, (place - 1 + first).cast("string"))

    unknown = [F.when(given(c).isNotNull() & code(c).isNull(), F.struct(F.lit(c).alias("field"), F.col(f"`{c}`").alias("answer"))) for c in offered]
    judged = answers.withColumn("_unknown", F.filter(F.array(*unknown), lambda one: one.isNotNull()))
    sound = judged.filter(F.size("_unknown") == 0).drop("_unknown").withColumns(
        {c: code(c) for c in offered} | {c: F.lit(v) for c, v in FORM_CONSTANTS.items()} | {c: F.trim(F.col(f"`{c}`")) for c in IDENTITY_FIELDS})
    faults = judged.select(F.trim(F.col("`Student ID`")).alias("Student ID"), F.inline("_unknown"))
    return sound, faults
