"""Code lists, patterns and word lists that decide results."""

# Report type codes and their labels.
REPORT_TYPES = {"EXP": "Expedited (15-day)", "PER": "Periodic", "DIR": "Direct"}

# Age groups by upper edge.
AGE_EDGES = [18, 45, 65, 75]
AGE_LABELS = ["0-17", "18-44", "45-64", "65-74", "75+"]

# Study status codes by group.
ACTIVE_STATUS = ["RECRUITING", "NOT_YET_RECRUITING", "ACTIVE_NOT_RECRUITING", "ENROLLING_BY_INVITATION"]
STOPPED_STATUS = ["TERMINATED", "WITHDRAWN", "SUSPENDED"]

# Study phase codes: label and sort position.
PHASE_GROUPS = {
    "EARLY_PHASE1": "Phase 1", "PHASE1": "Phase 1", "PHASE1|PHASE2": "Phase 1/2", "PHASE2": "Phase 2",
    "PHASE2|PHASE3": "Phase 2/3", "PHASE3": "Phase 3", "PHASE4": "Phase 4",
}
PHASE_SORT = {
    "EARLY_PHASE1": 1, "PHASE1": 1, "PHASE1|PHASE2": 2, "PHASE2": 3, "PHASE2|PHASE3": 4, "PHASE3": 5, "PHASE4": 6,
}

# Recall reasons, first match wins.
RECALL_REASONS = [
    ("STERIL", "Sterility assurance"),
    ("PARTICULATE|GLASS", "Particulate / foreign matter"),
    ("DELIVERY SYSTEM|DEVICE|IMPLANT|PEN|ADAPTER", "Device / delivery system"),
    ("STABILITY|SPECIFICATION|SUPERPOTENT|SUBPOTENT", "Quality specification"),
    ("LABEL", "Labelling"),
    ("CONTAINER|SHORT FILL|PACKAG", "Container / packaging"),
]

# Therapeutic area from condition terms, first match wins.
AREA_RULES = [
    ("NEOPLASM|CARCINOMA|CANCER|LYMPHOMA|LEUKEMIA|LEUKAEMIA|MYELOMA|MELANOMA|TUMOR|TUMOUR|SARCOMA|GLIOBLASTOMA"
     "|GLIOMA|MESOTHELIOMA", "Oncology"),
    ("HEMOPHILIA|HAEMOPHILIA|ANEMIA|ANAEMIA|HEMOGLOBINURIA|THROMBOCYTOPENI|SICKLE CELL|VON WILLEBRAND",
     "Haematology"),
    ("MULTIPLE SCLEROSIS|SPINAL MUSCULAR|ALZHEIMER|PARKINSON|HUNTINGTON|NEUROMYELITIS|AUTIS|EPILEP|DUCHENNE"
     "|MYASTHENIA|NERVOUS SYSTEM", "Neuroscience"),
    ("MACULAR|RETIN|UVEITIS|EYE DISEASE|VISION|GEOGRAPHIC ATROPHY", "Ophthalmology"),
    ("INFLUENZA|HIV|HEPATITIS|COVID|SARS-COV|INFECTION|CYTOMEGALOVIRUS|SEPSIS", "Infectious Diseases"),
    ("PULMONARY FIBROSIS|CYSTIC FIBROSIS|COPD|PULMONARY DISEASE|LUNG DISEASES, INTERSTITIAL", "Respiratory"),
    ("ARTHRITIS|LUPUS|ASTHMA|URTICARIA|SCLERODERMA|VASCULITIS|ARTERITIS|CROHN|COLITIS|PSORIASIS"
     "|LUPUS NEPHRITIS|FOOD HYPERSENSITIVITY|ALLERG", "Immunology"),
    ("HYPERTENSION|STROKE|MYOCARDIAL|HEART|CARDIOVASCULAR|THROMBOSIS|EMBOLISM", "Cardiovascular"),
    ("DIABETES|OBESITY|GROWTH|METABOLIC", "Metabolism & Endocrinology"),
]

# Display order of the areas.
AREA_ORDER = {
    "Oncology": 1, "Neuroscience": 2, "Immunology": 3, "Ophthalmology": 4, "Haematology": 5, "Respiratory": 6,
    "Infectious Diseases": 7, "Cardiovascular": 8, "Metabolism & Endocrinology": 9,
}
AREA_ORDER_OTHER = 99

# Reaction terms about product use, lack of effect or the disease itself, not a finding.
NON_CLINICAL_EXACT = [
    "off label use", "no adverse event", "drug ineffective", "death", "disease progression",
    "condition aggravated", "malignant neoplasm progression", "therapeutic response decreased",
    "therapeutic product effect decreased", "therapeutic product effect incomplete",
    "drug effect decreased", "drug effect incomplete", "treatment noncompliance", "therapy interrupted",
    "therapy cessation", "therapy non-responder", "therapy partial responder", "drug interaction",
    "underdose", "overdose", "contraindicated product administered",
    "inappropriate schedule of product administration", "incorrect dose administered",
    "incorrect route of product administration", "wrong technique in product usage process",
    "drug dose omission", "drug dose omission by device", "expired product administered",
    "exposure during pregnancy", "maternal exposure during pregnancy", "intentional product misuse",
    "intentional product use issue",
]
NON_CLINICAL_CONTAINS = "product |device|medication error|off label|circumstance or information"

# Indications that say nothing about the disease treated.
UNSPECIFIC_INDICATIONS = ["Product Used For Unknown Indication", "Off Label Use"]

# Outcome codes behind the seriousness flags.
DEATH, LIFE_THREATENING, HOSPITALISATION = "DE", "LT", "HO"

# Portfolio segments of products.
SEGMENT_LOE, SEGMENT_GROWTH, SEGMENT_OTHER = "Loss of exclusivity", "Growth (launched 2016+)", "Established"
GROWTH_SINCE = 2016

# Signal criteria.
MIN_CASES, PRR_THRESHOLD, CHI_THRESHOLD, MIN_INDICATION_SHARE = 3, 2.0, 4.0, 0.01
