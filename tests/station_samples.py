"""Station-file samples for tests.

GOLDEN is the complete sample that accompanies the original file format
(station line, header, five positional lines, one data row of 64 fields).
"""

# Fixed test data: the documented sample file, verbatim, in file order.
GOLDEN_STATION = "DP2,Version: BZ-02.00-25.41-71.84-01.04_1.2.1; BZ-02.01-25.41-71.84-01.04_1.2.1"
GOLDEN_HEADER = (
    "Product,SerialNumber,Special Build Name,Special Build Description,Unit Number,Station ID,"
    "Test Pass/Fail Status,StartTime,EndTime,List Of Failing Tests,Version,DFP,DFVDown,DFVUp,DBHP,"
    "DBHVDown,DBHVUp,PBSCC,PBS_X,PBS_Z,VBSDownCC,VBSDown_X,VBSDown_Z,VBSUpCC,VBSUp_X,VBSUp_Z,PBSTC,"
    "PBSTB,Preload_P,VBSDownTC,VBSDownTB,Preload_Vdown,VBSUpTC,VBSUpTB,Preload_Vup,Pallet Barcode,"
    "Cycle Time,Start_OP,DP1_CT,DP2_CT,Pallet Pickup,NG_DHP,NG_DHVDown,NG_DHVUp,NG_DBP,NG_DBVDown,"
    "NG_DBVUp,NG_DFP,NG_DFVDown,NG_DFVUp,NG_PBSCC,NG_VBSDownCC,NG_VBSUpCC,BBS2_NZ_1_FAIL,"
    "BBS2_NZ_2_FAIL,BBS2_NZ_3_FAIL,Shim_toss,PB Shim Press Force,VUP Shim Press Force,"
    "VD Shim Press Force,Dwell,Operator_ID,Mode,TestSeriesID"
)
GOLDEN_DISPLAY = "Display Name ----->"
GOLDEN_PRIORITY = (
    "PDCA Priority ----->,,,,,,,,,,,0,0,0,0,0,0,0,0,0,0,0,0,0,0,0,0,0,0,0,0,0,0,0,0,0,0,0,0,0,0"
    ",0,0,0,0,0,0,0,0,0,0,0,0,0,0,0,0,0,0,0,0,0,0,0"
)
GOLDEN_UPPER = (
    "Upper Limit ----->,,,,,,,,,,,0.23,0.87,0.87,NA,NA,NA,0.09,NA,NA,0.09,NA,NA,0.09,NA,NA,NA,N"
    "A,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,N"
    "A,NA,NA,NA,NA,NA,NA"
)
GOLDEN_LOWER = (
    "Lower Limit ----->,,,,,,,,,,,0.01,0.65,0.65,NA,NA,NA,0,NA,NA,0,NA,NA,0.00,NA,NA,NA,NA,NA,N"
    "A,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,N"
    "A,NA,NA,NA,NA"
)
GOLDEN_UNIT = (
    "Measurement Unit ----->,,,,,,,,,,,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA"
    ",NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA,NA"
    ",NA,NA,NA,NA"
)
GOLDEN_ROW = (
    "D22,C3970130009HP2NA6,,,,FXGL_C03-5FT-02B_1_AE-22,PASS,2017-01-14 15:31:30,"
    "2017-01-14 15:31:30,,BZ-02.01-25.41-71.84-01.04_1.2.1,.121,.769,.754,.568,1.293,1.299,.058,"
    ".058,.004,.046,.019,-.042,.068,-.047,-.049,.447,.47,.023,.524,.53,.00600000000000001,.545,.53,"
    ".015,111228320010,59.84,152932,27.04,32.8,20170114153131,0,0,0,0,0,0,0,0,0,0,0,0,0,0,0,0,.82,"
    ".77,.78,2,1,0,0"
)
GOLDEN_PREAMBLE = [GOLDEN_STATION, GOLDEN_HEADER, GOLDEN_DISPLAY, GOLDEN_PRIORITY, GOLDEN_UPPER,
                   GOLDEN_LOWER, GOLDEN_UNIT]


def golden_text(rows=(GOLDEN_ROW,)) -> str:
    return "\n".join(GOLDEN_PREAMBLE + list(rows)) + "\n"


def small_file(header="Product,SerialNumber,Station ID,StartTime,EndTime,A,B,C",
               upper="U,,,,,1,2,3", lower="L,,,,,0,0,0", unit="M,,,,,u,v,w",
               rows=("P1,S1,F_1_L_M,2020-01-01 00:00:00,2020-01-01 00:00:05,10,20,30",),
               station="ST9,Version: v1; v2") -> str:
    lines = [station, header, "Display Name ----->", "PDCA Priority ----->", upper, lower, unit]
    return "\n".join(lines + list(rows)) + "\n"
