"""Fixed values that results depend on."""

# The postings vocabulary applied to job descriptions.
DESCRIPTION_SKILLS = (
    "Python", "Java", "JavaScript", "SQL", "AWS", "Docker", "Kubernetes",
    "React", "Angular", "TensorFlow", "PyTorch", "Machine Learning",
    "Deep Learning", "NLP", "Data Analysis", "Tableau", "Power BI",
    "Spark", "Hadoop", "Linux", "Git", "Azure", "GCP", "DevOps",
    "CI/CD", "REST API", "Agile", "Scrum", "Cloud Computing", "Cybersecurity",
)

# The wider vocabulary applied to job title and description.
POSTING_SKILLS = (
    "Python", "Java", "JavaScript", "SQL", "AWS", "Docker", "Kubernetes",
    "React", "Vue.js", "Angular", "Node.js", "TypeScript", "Go", "Rust",
    "Machine Learning", "Data Science", "TensorFlow", "PyTorch",
    "DevOps", "CI/CD", "Git", "Linux", "Windows", "Cloud", "Azure",
    "REST API", "GraphQL", "Microservices", "Kafka", "RabbitMQ",
    "MongoDB", "PostgreSQL", "MySQL", "Scala", "C#", "C++", "PHP",
    "Ruby", "Swift", "Kotlin", "Spark", "Hadoop", "Hive",
    "Excel", "Tableau", "Power BI", "Looker",
    "Agile", "Scrum", "JIRA", "Salesforce", "SAP", "Oracle",
)

# Work type names and their codes.
WORK_TYPES = {
    "Full-Time": "FT",
    "Part-Time": "PT",
    "Contract": "CT",
    "Intern": "IN",
    "Temporary": "TP",
}

# Fixed value: the source name stored with listings from the raw postings file.
LISTING_SOURCE = "kaggle-jobs"

# Fixed value: the series key that stands for all postings together.
TOTAL_SERIES = "(job_listings_total)"

# Months of the bulk import, and the forecast range.
SPIKE_MONTHS = ("2024-02-01", "2024-03-01", "2024-04-01", "2024-05-01", "2024-06-01")
FORECAST_START = "2025-05-01"
FORECAST_END = "2027-12-01"
