"""Word lists, lookup tables and patterns that results depend on, stated as they are."""

from __future__ import annotations

# --- fixed values: languages' words -----------------------------------------------------------------

#: Words of the data-flow reader that are never variables: the language's, and options of command and query statements.
DATAFLOW_WORDS = frozenset(
    """
    END-IF END-READ END-EVALUATE END-PERFORM END-EXEC IF ELSE EVALUATE WHEN PERFORM GO GOTO GO-TO MOVE COMPUTE ADD
    SUBTRACT MULTIPLY DIVIDE SET INITIALIZE EXEC CICS CALL LINK XCTL RETURN EXIT STOP RUN THEN UNTIL VARYING SEARCH
    NEXT SENTENCE COPY REPLACE OF IN BY TO FROM GIVING WITH AND OR NOT EQUAL EQUALS GREATER LESS PROCEDURE DIVISION
    DATA ENVIRONMENT IDENTIFICATION SECTION WORKING-STORAGE LINKAGE FILE LOCAL-STORAGE SPECIAL-NAMES INPUT-OUTPUT
    CONFIGURATION SKIP1 SKIP2 EJECT ZERO PROGRAM COMMAREA CONVERTING CURSOR ZEROS ZEROES SPACE SPACES HIGH-VALUE
    HIGH-VALUES LOW-VALUE LOW-VALUES QUOTE QUOTES NULL NULLS ALL IS NUMERIC ALPHABETIC POSITIVE NEGATIVE GREATER-THAN
    LESS-THAN EQUAL-TO SQL INCLUDE WHENEVER SELECT INTO WHERE BEGIN DECLARE ASKTIME FORMATTIME SEND RECEIVE ADDRESS MAP
    MAPSET DATAONLY ERASE SYNCPOINT RESP RESP2 LENGTH SQLCA SQLCODE SQLSTATE SQLERRM REPLACING SUPPRESS TITLE SUBTITLE
    PAGE COLUMNS PIC PICTURE VALUE COMP COMP-3 COMP-5 BINARY DISPLAY SIGN SYNC REDEFINES OCCURS TIMES INDEXED INSPECT
    STRING UNSTRING ACCEPT OPEN CLOSE READ WRITE REWRITE DELETE START CONTINUE PREVIOUS ALLOCATE FREE MERGE SORT USE
    ABSTIME DATESEP DDMMYY MMDDYY YYMMDD DDMMYYYY YYYYMMDD TIME DATE SYSID TRANSID TASK CHANNEL CONTAINER NOSUSPEND WAIT
    DELETEQ WRITEQ READQ TS TD QUEUE ENQ DEQ STARTBR READNEXT READPREV ENDBR INSERT UPDATE GROUP ORDER HAVING JOIN LEFT
    RIGHT INNER OUTER UNION EXISTS LIKE BETWEEN COUNT SUM AVG MIN MAX SYSDATE CURRENT_DATE CURRENT_TIMESTAMP DUAL COMMIT
    ROLLBACK THRU THROUGH
    """.split()
)
#: Names with these prefixes are variables of the transaction monitor, whatever else they are.
MONITOR_PREFIXES = ("DFH", "EIB")
#: Words of the control-flow reader that are never paragraphs.
FLOW_WORDS = frozenset(
    """
    END-IF END-READ END-EVALUATE END-PERFORM END-EXEC IF ELSE EVALUATE WHEN PERFORM GO GOTO GO-TO MOVE COMPUTE ADD SUBTRACT
    MULTIPLY DIVIDE SET INITIALIZE EXEC CICS CALL LINK XCTL RETURN EXIT STOP RUN THEN UNTIL VARYING SEARCH NEXT SENTENCE
    SECTION DIVISION PROCEDURE DATA ENVIRONMENT IDENTIFICATION SPECIAL-NAMES
    """.split()
)
NOT_PARAGRAPHS = frozenset("END-IF END-EXEC EXIT EJECT SKIP1 SKIP2 SKIP3".split())
MONITOR_VERBS = ("LINK", "SEND", "RECEIVE", "XCTL", "RETURN", "SYNCPOINT", "ADDRESS", "ASKTIME", "FORMATTIME")
#: Copybooks of the system, which no package brings.
SYSTEM_COPYBOOKS = ("DFHAID", "DFHBMSCA", "SQLCA", "SQLDA")
COMMAREA_FIELDS = {"WPD1VOCI": "PD1VOCI", "WPD1FS00": "PD1FS00", "WPDRUTI01": "PDRUTI01", "PXCSEMAF-AREA": "PXCSEMAF"}
COMMAREA_PREFIXES = ("PD1FS00-", "PD1VOCI-", "PDRUTI01-", "PXCSEMAF-")

# --- fixed values: rules ----------------------------------------------------------------------------

PAGING_TOKENS = ("WCTRIG", "WCTPAG", "MAX-RIGHE", "NPAG", "NPAGT", "RIGHE", "PAG")
MODE_TOKENS = ("TWCOB-FUNZIONE", "TWCOB-VARCONT-NUMFUNZ", "TWCOB-XCTL-PGM")
SCREEN_TOKENS = ("EIBAID", "DFHENTER", "DFHPF1", "DFHPF2", "DFHPF3", "DFHPF4", "DFHPF7", "DFHPF8", "DFHPF9")
STATE_TOKEN = "TWCOB-FASE"
SEVERITY = {"error": "fatal", "permission": "block", "precondition": "guard", "validation": "reject", "control": "neutral"}
INVERTED = r"(?i)\(\s*NOT\s*\(.+?\)\s+OR\s+\(.+?\)\s*\)"
INVERTED_FLAG = "condition_maybe_inverted_notA_or_B"

# --- fixed values: job control ----------------------------------------------------------------------

CONTROL_DD = ("SYSIN", "STEPLIB", "JOBLIB", "SORTLIB", "JCLLIB", "SYSTSIN")
READ_DD = ("SORTIN", "INPUT", "INPSEQ", "SYSUT1")
WRITE_DD = ("SORTOUT", "OUTPUT", "SYSUT2")
CONTROL_OPERATIONS = ("IF", "ELSE", "ENDIF", "SET", "OUTPUT", "INCLUDE")
WARNING_WORDS = ("NON RIESEGUIBILE", "ATTENZIONE", "VERIFICARE", "ABEND", "ERRORE", "ERROR", "WARNING")
NO_PURPOSE = ("REQUISITI", "PRODOTTI", "RIESECUZIONE", "MODIFICATO")
COMMENT_SECTIONS = {"REQUISITI": "requirements", "PRODOTTI": "products", "RIESECUZIONE": "rerun_notes"}
JOB_PARAMETERS = ("RESTART=", "TYPRUN=", "COND=", "CLASS=", "MSGCLASS=", "MSGLEVEL=")
JOB_WORDS = ("LIBPROC ", "JOB ", "EXEC ", "PROC ", "PEND", "DD ", "DISP=", "VOL=", "DCB=", "UNIT=", "SYSOUT ", "SYSTSPRT ", "STEPLIB ")

# --- fixed values: comments -------------------------------------------------------------------------

HEADER_TERMS = (
    "IDENTIFICATION DIVISION", "ENVIRONMENT DIVISION", "DATA DIVISION", "PROCEDURE DIVISION", "CONFIGURATION SECTION",
    "INPUT-OUTPUT SECTION", "FILE SECTION", "WORKING-STORAGE SECTION", "LOCAL-STORAGE SECTION", "LINKAGE SECTION",
    "SCREEN SECTION", "REPORT SECTION", "COSTANTI", "VARIABILI", "MAPPE", "M A P P E", "SQL AREA", "S Q L A R E A",
)
HEADER_PREFIXES = (
    "AREA ", "AREA DI ", "AREA COMUNICAZIONE ", "INIZIO ", "VISUALIZZAZIONE ", "CALCOLO ", "PREPARAZIONE ", "IMPOSTA ", "IMPOSTAZIONE ",
    "TRASFERIMENTO ", "LETTURA ", "LINK ", "INVIO ", "RESET ", "SALVATAGGIO ", "INDIRIZZA ",
)
DIVISION = r"^\s*(IDENTIFICATION|ENVIRONMENT|DATA|PROCEDURE)\s+DIVISION\b"
SECTION = r"^\s*([A-Z][A-Z0-9-]{1,30})\s+SECTION\b"
LEVEL = r"^\s*(01|03|05|07|09|11|13|15|17|19|66|77|88)\b"
VERB = (
    r"^\s*(COPY|MOVE|IF|ELSE|END-IF|PERFORM|CALL|EXEC\b|INITIALIZE|COMPUTE|SET|SEARCH|READ|WRITE|REWRITE|DELETE|OPEN|CLOSE|START|ACCEPT|DISPLAY|"
    r"GO\s+TO|GOBACK|STOP\s+RUN|ADD|SUBTRACT|MULTIPLY|DIVIDE|STRING|UNSTRING|INSPECT|EVALUATE)\b"
)
CLAUSE = (
    r"\b(PIC|PICTURE|VALUE|COMP(-[1-9])?|COMP-3|BINARY|REDEFINES|OCCURS|USAGE|INDEXED|DEPENDING|VARYING|UNTIL|ASCENDING|DESCENDING|THRU|THROUGH|"
    r"END-EXEC|END-IF|END-EVALUATE|SQLCA|CURSOR|SUPPRESS)\b"
)
OPENING = r"^\s*(FD|SD|SELECT|COPY|EXEC|PROGRAM-ID|FILE-CONTROL|EJECT|SKIP[0-9])\b"
PARAGRAPH = r"^\s*([A-Z][A-Z0-9-]{1,30})\.\s*$"
WHITE = " \t\n\r\f\x0b"
