"""Clinical code lists and category names the predicates compare against."""

# Three-character procedure codes of endoscopies.
ENDOSCOPY = (
    "G14", "G15", "G16", "G17", "G18", "G19", "G20",
    "G42", "G43", "G44", "G45", "G46", "G54", "G55", "G64", "G65", "G79", "G80",
    "H23", "H24", "H25", "H26", "H27", "H28", "H37", "H69", "H70", "H71",
    "J38", "J39", "J40", "J41", "J42", "J43", "J44", "J45",
    "H20", "H21", "H22", "H68",
    "E48", "E49", "E50", "E51",
)

# Three-character procedure codes of deliveries.
NORMAL_BIRTH = ("R24",)
ASSISTED_BIRTH = ("R19", "R20", "R21", "R22", "R23")
NON_ELECTIVE_SECTION = ("R18",)
ELECTIVE_SECTION = ("R17",)

# Three-character procedure codes done in a catheter laboratory.
CARDIAC_CATHETER = ("K63", "K75", "K60", "K62", "K59", "K57", "K73", "K49")

# Treatment specialty codes.
RENAL = ("361",)
HAEMATOLOGY_ONCOLOGY = ("253", "303", "260", "370", "800")
CARDIOLOGY = ("320", "321")
INTERVENTIONAL_RADIOLOGY = ("811", "280")

# Admission methods of planned day cases.
PLANNED_ADMISSION = ("11", "12", "13")

# Patient classes.
ORDINARY = "1"
DAY_CASE = "2"
REGULAR_ATTENDER = ("3", "4")

# Emergency department types and acuities.
MAJOR_DEPARTMENT = "01"
SAME_DAY_EMERGENCY_CARE = "05"
MINOR_ACUITY = ("standard", "non-urgent", "urgent")
MAJOR_ACUITY = "very-urgent"
RESUS_ACUITY = "immediate-resuscitation"

# Specialty types of the lookup, the maternity group, the age limit.
MEDICAL = "Medical/Other"
SURGICAL = "Surgical"
MATERNITY_GROUP = "maternity"
ADULT_AGE = 18
