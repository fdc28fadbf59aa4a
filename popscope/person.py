"""The spec of a table of synthetic persons: 26 columns, all text but the age."""

from __future__ import annotations

from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from popscope.spec import Dimension, PopulationSpec, categorical, freetext, number_range

# Column names, category values, age range and decade suffix of the data.
TEXT_COLUMNS = (
    "uuid",
    "professional_persona", "sports_persona", "arts_persona", "travel_persona",
    "culinary_persona", "family_persona", "persona",
    "cultural_background",
    "skills_and_expertise", "skills_and_expertise_list",
    "hobbies_and_interests", "hobbies_and_interests_list",
    "career_goals_and_ambitions",
    "sex", "marital_status", "military_status", "family_type", "housing_type",
    "education_level", "bachelors_field", "occupation",
    "district", "province", "country",
)
SEX = ("남자", "여자")
MARITAL_STATUS = ("미혼", "배우자있음", "이혼", "사별")
EDUCATION_LEVEL = ("초등학교", "중학교", "고등학교", "전문대학", "대학교", "대학원(석사)", "대학원(박사)")
HOUSING_TYPE = ("아파트", "단독주택", "다세대주택", "연립주택", "오피스텔", "기타")
AGE_RANGE = (19, 99)
DECADE_SUFFIX = "대"

PERSON_SCHEMA = StructType(
    [StructField(name, StringType()) for name in TEXT_COLUMNS[:15]]
    + [StructField("age", IntegerType())]
    + [StructField(name, StringType()) for name in TEXT_COLUMNS[15:]]
)

PERSON = PopulationSpec(
    id="uuid",
    schema=PERSON_SCHEMA,
    columns=(
        categorical("province", "Province or metropolitan city"),
        categorical("district", "District, written with its province before a hyphen", list_values=False),
        categorical("sex", "Sex", values=SEX, closed=True),
        number_range("age", "Age; filter with age_range: (low, high)", bounds=AGE_RANGE, whole=True),
        categorical("marital_status", "Marital status", values=MARITAL_STATUS),
        categorical("education_level", "Highest education", values=EDUCATION_LEVEL),
        categorical("housing_type", "Housing", values=HOUSING_TYPE),
        categorical("family_type", "Household form"),
        freetext("occupation", "Occupation, free text; filter with occupation_contains"),
    ),
    strata={
        "province": Dimension("province"),
        "age_decade": Dimension("age", decades=True),
        "education_level": Dimension("education_level"),
        "sex": Dimension("sex"),
    },
    dimensions={
        "province": Dimension("province"),
        "district": Dimension("district"),
        "sex": Dimension("sex"),
        "age_decade": Dimension("age", decades=True, suffix=DECADE_SUFFIX),
        "marital_status": Dimension("marital_status"),
        "education_level": Dimension("education_level"),
        "housing_type": Dimension("housing_type"),
        "family_type": Dimension("family_type"),
        "occupation": Dimension("occupation"),
    },
    passage=("persona", "hobbies_and_interests", "career_goals_and_ambitions"),
    summary=("sex", "age", "province", "district", "occupation"),
)
