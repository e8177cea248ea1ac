"""Prompt texts and the expressions that fill them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prompt texts, word for word.  Names in braces are filled per row.
DESCRIBE_INTRODUCTION = """\
Answer the question using the following information.

First, consider the dataset sample:

{dataset_sample}
"""
DESCRIBE_PROFILE_INSTRUCTION = """\
Additionally, the dataset profile is as follows:

{dataset_profile}

Based on this profile, please add sentence(s) to enrich the dataset description.
"""
DESCRIBE_SEMANTIC_INSTRUCTION = """\
Furthermore, the semantic profile of the dataset columns is as follows:
{semantic_profile}

Based on this information, please add sentence(s) discussing the semantic profile in the description.
"""
DESCRIBE_TOPIC_INSTRUCTION = """\
Moreover, the dataset topic is: {data_topic}. Based on this topic, please add sentence(s) describing what this dataset can be used for.
"""
DESCRIBE_CLOSING_INSTRUCTION = """\
Question: Based on the information above and the requirements, provide a dataset description in sentences. Use only natural, readable sentences without special formatting.

Answer:
"""
DESCRIBE_SYSTEM_MESSAGE = """\
You are an assistant for a dataset search engine. Your goal is to improve the readability of dataset descriptions for dataset search engine users."""
SEARCH_TEMPLATE = """\
Dataset Overview:
- Please keep the exact initial description of the dataset as shown in beginning the prompt.

Key Themes or Topics:
- Central focus on a broad area of interest (e.g., urban planning, socio-economic factors, environmental analysis).
- Data spans multiple subtopics or related areas that contribute to a holistic understanding of the primary theme.
Example:
- theme1/topic1
- theme2/topic2
- theme3/topic3

Applications and Use Cases:
- Facilitates analysis for professionals, policymakers, researchers, or stakeholders.
- Useful for specific applications, such as planning, engineering, policy formulation, or statistical modeling.
- Enables insights into patterns, trends, and relationships relevant to the domain.
Example:
- application1/usecase1
- application2/usecase2
- application3/usecase3

Concepts and Synonyms:
- Includes related concepts, terms, and variations to ensure comprehensive coverage of the topic.
- Synonyms and alternative phrases improve searchability and retrieval effectiveness.
Example:
- concept1/synonym1
- concept2/synonym2
- concept3/synonym3

Keywords and Themes:
- Lists relevant keywords and themes for indexing, categorization, and enhancing discoverability.
- Keywords reflect the dataset's content, scope, and relevance to the domain.
Example:
- keyword1
- keyword2
- keyword3

Additional Context:
- Highlights the dataset's relevance to specific challenges or questions in the domain.
- May emphasize its value for interdisciplinary applications or integration with related datasets.
Example:
- context1
- context2
- context3"""
SEARCH_USER_PROMPT = """\
You are given a dataset about the topic {topic}, with the following initial description:

{initial_description}

Please expand the description by including the exact topic. Additionally, add as many related concepts, synonyms, and relevant terms as possible based on the initial description and the topic.

Unlike the initial description, which is focused on presentation and readability, the expanded description is intended to be indexed at the backend of a dataset search engine to improve searchability.

Therefore, focus less on readability and more on including all relevant terms related to the topic. Make sure to include any variations of the key terms and concepts that could help improve retrieval in search results.

Please follow the structure of the following example template:
{template}
"""
SEARCH_SYSTEM_MESSAGE = """\
You are an assistant for a dataset search engine. Your goal is to improve the performance of the dataset search engine for keyword queries."""
SEMANTIC_TEMPLATE = """\
{'Temporal':
    {
        'isTemporal': Does this column contain temporal information? Yes or No,
        'resolution': If Yes, specify the resolution (Year, Month, Day, Hour, etc.).
    },
 'Spatial': {'isSpatial': Does this column contain spatial information? Yes or No,
             'resolution': If Yes, specify the resolution (Country, State, City, Coordinates, etc.).},
 'Entity Type': What kind of entity does the column describe? (e.g., Person, Location, Organization, Product),
 'Domain-Specific Types': What domain is this column from (e.g., Financial, Healthcare, E-commerce, Climate, Demographic),
 'Function/Usage Context': How might the data be used (e.g., Aggregation Key, Ranking/Scoring, Interaction Data, Measurement).}
"""
SEMANTIC_RESPONSE_EXAMPLE = """\
{
"Domain-Specific Types": "General",
"Entity Type": "Temporal Entity",
"Function/Usage Context": "Aggregation Key",
"Spatial": {"isSpatial": false,
            "resolution": ""},
"Temporal": {"isTemporal": true,
            "resolution": "Year"}
}
"""
SEMANTIC_USER_PROMPT = """\
You are a dataset semantic analyzer. Based on the column name and sample values, classify the column into multiple semantic types.
Please group the semantic types under the following categories:
'Temporal', 'Spatial', 'Entity Type', 'Data Format', 'Domain-Specific Types', 'Function/Usage Context'.
Following is the template {template}
Please follow these rules:
1. The output must be a valid JSON object that can be directly loaded by json.loads. Example response is {response_example}
2. All keys from the template must be present in the response.
3. All keys and string values must be enclosed in double quotes.
4. There must be no trailing commas.
5. Use booleans (true/false) and numbers without quotes.
6. Do not include any additional information or context in the response.
7. If you are unsure about a specific category, you can leave it as an empty string.

Column name: {column_name}
Sample values: {sample_values}
"""
SEMANTIC_SYSTEM_MESSAGE = "You are a helpful assistant skilled in dataset semantic analysis."
SEMANTIC_GROUP_RESPONSE_EXAMPLE = """\
{
  "column1": {
    "Domain-Specific Types": "General",
    "Entity Type": "Temporal Entity",
    "Function/Usage Context": "Aggregation Key",
    "Spatial": {"isSpatial": false, "resolution": ""},
    "Temporal": {"isTemporal": true, "resolution": "Year"}
  },
  "column2": {
    "Domain-Specific Types": "Financial",
    "Entity Type": "Numeric Entity",
    "Function/Usage Context": "Measurement",
    "Spatial": {"isSpatial": false, "resolution": ""},
    "Temporal": {"isTemporal": false, "resolution": ""}
  }
}
"""
SEMANTIC_GROUP_USER_PROMPT = """\
You are a dataset semantic analyzer. Analyze multiple columns at once and classify each column into multiple semantic types.

For each column provided below, classify it into semantic types under the following categories:
'Temporal', 'Spatial', 'Entity Type', 'Data Format', 'Domain-Specific Types', 'Function/Usage Context'.

Template for each column:
{template}

Please follow these rules:
1. The output must be a valid JSON object where each key is a column name and each value is the semantic type classification for that column.
2. All keys from the template must be present in each column's classification.
3. All keys and string values must be enclosed in double quotes.
4. There must be no trailing commas.
5. Use booleans (true/false) and numbers without quotes.
6. Do not include any additional information or context in the response.
7. If you are unsure about a specific category for a column, you can leave it as an empty string.

Example response format:
{response_example}

Columns to analyze:
{columns_text}

Return a JSON object with column names as keys and their semantic classifications as values:
"""
TOPIC_SYSTEM_MESSAGE = "You are an assistant for generating concise dataset topics."
TOPIC_USER_PROMPT = """\
Using the dataset information provided, generate a concise topic in 2-3 words that best describes the dataset's primary theme.

Title: {title}
{description_block}
Dataset Sample: {dataset_sample}

Topic (2-3 words):
"""
QUALITY_SYSTEM_MESSAGE = """\
You are a helpful and precise assistant for checking the quality of the dataset description."""
QUALITY_USER_PROMPT = """\
You will be given one tabular dataset description. Your task is to rate the description on 3 metrics.
Please make sure you read and understand these instructions carefully. Please keep this document open while reviewing, and refer to it as needed.

Evaluation Criteria:
1. Completeness (1-10) - Evaluates how thoroughly the dataset description covers essential aspects such as the scope of data, query workloads, summary statistics, and possible tasks or applications.
A high score indicates that the description provides a comprehensive overview, including details on dataset size, structure, fields, and potential use cases.
2. Conciseness (1-10) - Measures the efficiency of the dataset description in conveying necessary information without redundancy.
A high score indicates that the description is succinct, avoiding unnecessary details while employing semantic types (e.g., categories, entities) to streamline communication.
3. Readability (1-10) -  Evaluates the logical flow and readability of the dataset description.
A high score suggests that the description progresses logically from one section to the next, creating a coherent and integrated narrative that facilitates understanding of the dataset.

Evaluation Steps:
Read the dataset description carefully and identify the main topic and key points. Assign a score for each criteria on a scale of 1 to 10, where 1 is the lowest and 10 is the highest based on the Evaluation Criteria.

Example 1:
Description: The dataset provides information on alcohol-impaired driving deaths and occupant deaths across various states in the United States. It includes data for 51 states, detailing the number of alcohol-impaired driving deaths and occupant deaths, with values ranging from 0 to 3723 and 0 to 10406, respectively. Each entry also contains the state abbreviation and its geographical coordinates. The dataset is structured with categorical and numerical data types, focusing on traffic safety and casualty statistics. Key attributes include state names, death counts, and location coordinates, making it a valuable resource for analyzing traffic safety trends and issues related to impaired driving.
Evaluation Form (scores ONLY): Completeness: 7, Conciseness: 9, Readability: 9

Example 2:
Description: The dataset provides a comprehensive overview of traffic safety statistics across various states in the United States, specifically focusing on alcohol-impaired driving deaths and occupant deaths. It includes data from 51 unique states, represented by their two-letter postal abbreviations, such as MA (Massachusetts), SD (South Dakota), AK (Alaska), MS (Mississippi), and ME (Maine). Each entry in the dataset captures critical information regarding the number of alcohol-impaired driving deaths and the total occupant deaths resulting from traffic incidents.
The column "Alcohol-Impaired Driving Deaths" is represented as an integer, indicating the number of fatalities attributed to alcohol impairment while driving. The dataset reveals a range of values, with the highest recorded number being 2367 deaths in Mississippi, highlighting the severity of the issue in certain regions. In contrast, states like Alaska report significantly lower figures, with only 205 alcohol-impaired driving deaths.
The "Occupant Deaths" column also consists of integer values, representing the total number of deaths among vehicle occupants, regardless of the cause. This data spans from 0 to 10406, with Mississippi again showing the highest number of occupant deaths at 6100, which raises concerns about overall traffic safety in the state.
Additionally, the dataset includes a "Location" column that provides geographical coordinates for each state, enhancing the spatial understanding of the data. The coordinates are formatted as latitude and longitude pairs, allowing for potential mapping and geographical analysis of traffic safety trends.
Overall, this dataset serves as a valuable resource for researchers, policymakers, and public safety advocates aiming to understand and address the impact of alcohol on driving safety across different states. It highlights the need for targeted interventions and policies to reduce alcohol-impaired driving incidents and improve occupant safety on the roads.
Evaluation Form (scores ONLY): Completeness: 8, Conciseness: 7, Readability: 8

Please provide scores for the given dataset description based on the Evaluation Criteria. Do not include any additional information or comments in your response.
Evaluation Form (scores ONLY):
"""
PAIR_SYSTEM_MESSAGE = """\
You are a helpful and precise assistant for judging the quality of dataset descriptions."""
PAIR_USER_PROMPT = """\
You will be shown two descriptions of the same dataset, A and B.
Please select which description is better overall, based on completeness, conciseness, and readability.
Respond with exactly "A" or "B" (without any additional text).

Description A:
{desc_a}

Description B:
{desc_b}

Evaluation Criteria:
- Completeness (1-10) - Evaluates how thoroughly the dataset description covers essential aspects such as the scope of data, query workloads, summary statistics, and possible tasks or applications. A high score indicates that the description provides a comprehensive overview, including details on dataset size, structure, fields, and potential use cases.
- Conciseness (1-10) - Measures the efficiency of the dataset description in conveying necessary information without redundancy. A high score indicates that the description is succinct, avoiding unnecessary details while employing semantic types (e.g., categories, entities) to streamline communication.
- Readability (1-10) -  Evaluates the logical flow and readability of the dataset description. A high score suggests that the description progresses logically from one section to the next, creating a coherent and integrated narrative that facilitates understanding of the dataset.

Which description is better?
"""
SEMANTIC_GROUP_SYSTEM_MESSAGE = (
    "You are a helpful assistant skilled in dataset semantic "
    "analysis. You analyze multiple columns efficiently in a "
    "single response."
)
PROFILE_HEADING = "The key data profile information for this dataset includes:"
SEMANTIC_HEADING = "The key semantic information for this dataset includes:"


def fill(text: str, /, **values: Column) -> Column:
    """The template with each ``{name}`` replaced by a column."""
    parts: list[Column] = []
    rest = text
    while rest:
        spots = [(rest.find("{" + n + "}"), n) for n in values if "{" + n + "}" in rest]
        if not spots:
            parts.append(F.lit(rest))
            break
        at, name = min(spots)
        if at:
            parts.append(F.lit(rest[:at]))
        parts.append(values[name])
        rest = rest[at + len(name) + 2 :]
    return F.concat(*parts)


def description_prompt(
    sample: Column,
    profile: Column | None = None,
    semantic: Column | None = None,
    topic: Column | None = None,
    num_words: Column | int = 100,
) -> Column:
    """Introduction, the sections that have a text, closing, target length; one per line.

    A section column that is null or empty leaves its section out.
    """

    def section(template: str, **value: Column) -> Column:
        (column,) = value.values()
        return F.when(column != "", fill(template, **value))

    words = num_words if isinstance(num_words, Column) else F.lit(num_words)
    parts = [fill(DESCRIBE_INTRODUCTION, dataset_sample=sample)]
    if profile is not None:
        parts.append(section(DESCRIBE_PROFILE_INSTRUCTION, dataset_profile=profile))
    if semantic is not None:
        parts.append(section(DESCRIBE_SEMANTIC_INSTRUCTION, semantic_profile=semantic))
    if topic is not None:
        parts.append(section(DESCRIBE_TOPIC_INSTRUCTION, data_topic=topic))
    parts.append(F.lit(DESCRIBE_CLOSING_INSTRUCTION))
    parts.append(
        F.concat(F.lit("Target length: approximately "), words.cast("string"), F.lit(" words."))
    )
    return F.when(sample.isNotNull(), F.concat_ws("\n", *parts))


def topic_prompt(title: Column, original: Column, sample: Column) -> Column:
    block = F.when(
        original != "", F.concat(F.lit("Original Description: "), original, F.lit("\n"))
    ).otherwise(F.lit(""))
    return fill(
        TOPIC_USER_PROMPT,
        title=F.coalesce(title, F.lit("")),
        description_block=F.coalesce(block, F.lit("")),
        dataset_sample=sample,
    )


def search_prompt(description: Column, topic: Column) -> Column:
    return fill(
        SEARCH_USER_PROMPT,
        topic=topic,
        initial_description=description,
        template=F.lit(SEARCH_TEMPLATE),
    )


def column_prompt(name: Column, values: Column) -> Column:
    return fill(
        SEMANTIC_USER_PROMPT,
        template=F.lit(SEMANTIC_TEMPLATE),
        response_example=F.lit(SEMANTIC_RESPONSE_EXAMPLE),
        column_name=name,
        sample_values=F.array_join(values, ", "),
    )


def quoted_list(values: Column) -> Column:
    """A string list as ``['a', 'b']``; double quotes when only an apostrophe is inside."""

    special = "[\\\\\n\r\t']"

    def literal(v: Column) -> Column:
        escaped = F.replace(v, F.lit("\\"), F.lit("\\\\"))
        escaped = F.replace(escaped, F.lit("\n"), F.lit("\\n"))
        escaped = F.replace(escaped, F.lit("\r"), F.lit("\\r"))
        escaped = F.replace(escaped, F.lit("\t"), F.lit("\\t"))
        apostrophe, double = v.contains("'"), v.contains('"')
        single = F.concat(
            F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'")
        )
        return (
            F.when(~v.rlike(special), F.concat(F.lit("'"), v, F.lit("'")))
            .when(apostrophe & ~double, F.concat(F.lit('"'), escaped, F.lit('"')))
            .otherwise(single)
        )

    # One look at the joined values spares a look at each.
    plain = (F.size(values) > 0) & ~F.exists(values, lambda v: v.isNull()) & ~F.array_join(values, "").rlike(special)
    joined = F.concat(F.lit("'"), F.array_join(values, "', '"), F.lit("'"))
    inside = F.when(plain, joined).otherwise(F.array_join(F.transform(values, literal), ", "))
    return F.concat(F.lit("["), inside, F.lit("]"))


def group_prompt(columns: Column) -> Column:
    """One prompt for an ``array<struct<col_name, sample_values>>``."""
    blocks = F.transform(
        columns,
        lambda c: F.concat(
            F.lit("Column: "),
            c["col_name"],
            F.lit("\nSample values: "),
            quoted_list(c["sample_values"]),
        ),
    )
    return fill(
        SEMANTIC_GROUP_USER_PROMPT,
        template=F.lit(SEMANTIC_TEMPLATE),
        response_example=F.lit(SEMANTIC_GROUP_RESPONSE_EXAMPLE),
        columns_text=F.array_join(blocks, "\n\n"),
    )


def quality_prompt(description: Column) -> Column:
    return F.concat(
        F.lit(QUALITY_USER_PROMPT + "\nDescription: "),
        description,
        F.lit("\nEvaluation Form (scores ONLY): "),
    )


def pair_prompt(a: Column, b: Column) -> Column:
    return fill(PAIR_USER_PROMPT, desc_a=a, desc_b=b)
