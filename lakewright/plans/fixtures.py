"""Small invented inputs for operators whose sources the driver's tables don't hold, as frames and as SQL VALUES."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_COBOL = """\
       IDENTIFICATION DIVISION.
       PROGRAM-ID. BILLRUN.
      * BILLING RUN FOR OPEN ORDERS
       DATA DIVISION.
       WORKING-STORAGE SECTION.
      *---------------------------------------------------------
      * AREA DI LAVORO
       01  WS-TOTAL            PIC 9(7) COMP-3.
       01  WS-STATUS           PIC X.
           COPY PDCUST01.
       LINKAGE SECTION.
       01  DFHCOMMAREA.
           05 TWCOB-FASE        PIC X.
           05 TWCOB-FUNZIONE    PIC X.
       01  LK-OTHER             PIC X.
       PROCEDURE DIVISION.
           PERFORM INIT-RUN THRU INIT-RUN-EXIT.
           IF TWCOB-FASE = '1'
              GO TO FIRST-PHASE.
           IF TWCOB-FASE = '2' OR '3' THEN
              GO TO SECOND-PHASE.
           GO TO ABEND-RUN.
       INIT-RUN.
      * Clears the totals before the first order is read.
           MOVE ZERO TO WS-TOTAL.
           MOVE 'N' TO WS-STATUS.
      *    MOVE SPACES TO WS-STATUS.
       INIT-RUN-MID.
           ADD 1 TO WS-TOTAL.
       INIT-RUN-EXIT.
           EXIT.
       FIRST-PHASE.
           IF EIBAID = DFHPF3
              GO TO LEAVE-RUN.
           EXEC CICS SEND MAP('BILLM1') MAPSET('BILLMS')
                ERASE END-EXEC.
           COMPUTE WS-TOTAL = WS-TOTAL + CUST-LIMIT.
           PERFORM ADD-LINE UNTIL WS-STATUS = 'Y'.
           GO TO LEAVE-RUN.
       SECOND-PHASE.
           MOVE 'THE MESSAGE IS TOO LONG FOR ONE LI
      -        'NE' TO WS-STATUS.
           CALL 'TAXCALC' USING WS-TOTAL BY REFERENCE CUST-LIMIT.
           EXEC CICS LINK PROGRAM('PRICER') COMMAREA(WPD1VOCI)
                LENGTH(200) END-EXEC.
           MOVE PD1VOCI-RETURN TO WS-STATUS.
           GO TO LEAVE-RUN.
       ADD-LINE.
           SET WS-STATUS TO CUST-FLAG. *> keeps the flag of the customer
       LEAVE-RUN.
           EXEC CICS RETURN END-EXEC.
       ABEND-RUN.
           STOP RUN.
"""

_JCL = """\
//BILLJOB  JOB (ACCT),'BILLING',CLASS=A
//* REQUISITI
//* - orders of the day
//*   are closed
//* Bills all open orders
//*
//BILLP    PROC
//PSTEP    EXEC PGM=PRINTER
//PIN      DD DSN=PROD.BILLS,DISP=SHR
//POUT     DD SYSOUT=*
//BILLPE   PEND
//         SET ENV=PROD
//* First the old file goes
//CLEAN    EXEC PGM=IEFBR14
//OLD      DD DSN=PROD.BILLS,DISP=(OLD,DELETE)
//MAKE     EXEC PGM=BILLRUN,PARM='A,B'  makes the bills
//ORDERS   DD DSN=PROD.ORDERS,DISP=SHR
//         DD DSN=PROD.ORDERS2,DISP=SHR
//BILLS    DD DSN=PROD.BILLS,
//         DISP=(NEW,CATLG,DELETE)
//TMP      DD DSN=&&WORK,DISP=(,PASS)
//SYSIN    DD DUMMY
//LOST     DD DSN=PROD.LOST <== VERIFICARE
//PRINT    EXEC BILLP
//SEND     EXEC MAILER
//LAST     EXEC PGM=IEFBR14
//GONE     DD DSN=PROD.BILLS,DISP=(MOD,DELETE)
"""

_FACTS = """\
COPY,u0,f0,EARLY
FILE,u1,D:\\src\\BILLRUN.cbl,20260120104353381
COPY,u2,f1,PDCUST01
COPY,u3,f1,DFHAID
COPY,u4,f1,pdcust01
COPY,u5,f1,PDRUTI01
SQLINCLUDE,u6,f1,SQLCA
PGM,u7,f1,BILLRUN,120,34,9,x
CALL,u8,p1,BILLRUN,CALL,TAXCALC
CALL,u9,p1,BILLRUN,CICSLINK,PRICER
CALL,u9,p1,BILLRUN,CICSLINK,"PRI,CE"
UNRESOLVEDCALL,u10,p1,BILLRUN,CALL,WS-PGM
DB2TABLE,u11,p1,ORDERS,SELECT
DB2TABLE,u12,p1,ORDERS,UPDATE
CICSREAD,u13,p1,CUSTFILE
MYSTERY,a
mystery,b
FILE,v1,/src/taxcalc.cbl,20260121
PGM,v2,f2,TAXCALC,40,x,3
COPY,v3,f2,PDCUST01
CALL,v4,p2,TAXCALC,CICSXCTL,MENU
DB2TABLE,v5,p2,DUAL,SELECT
"""


def _lines(file: str, text: str) -> list[tuple]:
    return [(file, i, line) for i, line in enumerate(text.splitlines(), 1)]


_LINES = "file string, line_no int, raw string"
FIXTURES: dict[str, tuple[str, list[tuple]]] = {
    "fx_cobol": (_LINES, _lines("src/BILLRUN.cbl", _COBOL)),
    "fx_jcl": (_LINES, _lines("jcl/BILLJOB.jcl", _JCL) + _lines("jcl/OTHER.jcl", "//OTHER    JOB\n//MAILER   PROC\n//M        EXEC PGM=SMTP\n//ME       PEND\n//RUN      EXEC NOWHERE\n")),
    "fx_facts": (_LINES, _lines("facts/result.txt", _FACTS)),
    "fx_dot": ("file string, text string", [
        ("a.dot", "digraph A {\n rankdir=LR;\n <MAIN>-><B C>;\n <B C> -> <D>;\n <MAIN>-><D>;\n}"),
        ("b.dot", "<A>-><B>;"), ("c.dot", "digraph C { rankdir=TB; }"), ("d.dot", ""),
    ]),
    "fx_copybooks": ("name string", [("DFHAID",), ("SQLCA",), ("PDPSQL1",), ("MYSQLER",), ("PDIERR",), ("XABENDX",), ("PDRUTI01",), ("PDRTWA2",), ("PXCSEMA",), ("ASEMA",), ("PRBOOK",), ("ZZTOP",), (" pdx ",)]),
    "fx_calls": ("call_type string, target string", [("CICSXCTL", "MENU"), ("CICSLINK", "PRICER"), ("CALL", "PXCSEMAF"), ("CALL", "PDRUTI01"), ("CALL", "TAXCALC"), ("START", "T1"), ("cicslink", "x")]),
    "fx_edges": ("program string, edge_no int, src string, dst string, type string, condition string, evidence string", [
        ("P", 1, "MAIN", "ABEND-RUN", "JUMP", "TWCOB-FUNZIONE = 'X'", "GO TO ABEND-RUN"),
        ("P", 2, "MAIN", "XCTL-MENU", "JUMP", "WCTPAG = 1", None),
        ("P", 3, "MAIN", "A", "JUMP", "EIBAID = DFHPF3", "GO TO A"),
        ("P", 4, "MAIN", "B", "JUMP", "(NOT (EIBAID = DFHENTER) OR (EIBAID = DFHPF1))", None),
        ("P", 5, "A", "RETURN", "JUMP", "X = '1'", None),
        ("P", 6, "A", "C", "CALL", "TWCOB-FASE  = '2'", None),
        ("P", 7, "A", "D", "JUMP", "TWCOB-FUNZIONE = 'I'", None),
        ("P", 8, "B", "D", "FALLTHROUGH", None, None),
        ("P", 9, "C", "D", "JUMP", "TWCOB-FASE = '1'", None),
        ("P", 10, "D", "MAIN", "JUMP", "", None),
        ("P", 11, "Z", "Y", "JUMP", "((((A = 1))))", None),
        ("P", 12, "Y", "Z", "JUMP", "(A = 1 OR B = 2 OR A = 1", None),
        ("P", 13, "Y", "W", "JUMP", "A = 1 AND", None),
        ("Q", 1, "Q", "R", "JUMP", "NUMERO = 0", None),
    ]),
    "fx_order": ("file string, paragraph string, ord int", [("f", p, i) for i, p in enumerate(["A", "B", "C", "D", "E"])] + [("g", "A", 0), ("g", "B", 1)]),
    "fx_ranges": ("file string, range_start string, range_end string", [("f", "A", "C"), ("f", "B", "D"), ("f", "D", "B"), ("f", "A", "X"), ("g", "A", "B")]),
    "fx_conditions": ("id int, condition string", [(i, c) for i, c in enumerate(["X = 'I' OR 'A'", "(X = 'I') AND (X = 'A')", "NOT (A NOT GREATER B)", "A = 1 OR A = 1 OR B = 2", "A = 1 OR (A = 1 AND B = 2)", "NOT (X = 'I') AND X = 'I'", "((A = 1", "TAB(I) = 'X' AND (B = 1 OR C = 2)", "", None])]),
    "fx_texts": ("id int, text string", [(i, t) for i, t in enumerate(["  Padded NAME. ", "name.,", "MOVE 'A''B' TO X-1 Y", "two  spaces\tand\n\n lines ", "a/b\\c.tar.gz", "MIXED 'quo<==ted' <== a  note", "DSN=A,DISP=(NEW,CATLG),PARM='x,y'  note", "123456 CODE *> why", "→ and â†’", "", None])]),
    "fx_dds": ("id int, ddname string, disp string, sysout string, raw string, dsn string, program string", [
        (1, "OUT", None, "*", "DD SYSOUT=*", None, "P"), (2, "NUL", None, None, "DD DUMMY", None, "P"), (3, "SYSIN", "SHR", None, "DD DSN=A,DISP=SHR", "A", "P"), (4, "X", "(OLD,DELETE)", None, "DD", "A", "IEFBR14"),
        (5, "SORTIN", "NEW", None, "DD", "A", "P"), (6, "SORTOUT", "SHR", None, "DD", "SYS1.LIB", "P"), (7, "X", " ( SHR , KEEP )", None, "DD", "A", None), (8, "X", "(MOD,CATLG)", None, "DD", "&&T", "P"), (9, "X", "(,PASS)", None, "DD", "&&T", "P"),
        (10, "X", None, None, "DD", "SYSOUT.X", "P"), (11, "X", None, None, "DD *", None, "P"), (12, None, "(OLD,CATLG,DELETE)", "", "DD", "", "P"),
    ]),
    "fx_usage": ("file string, job string, dsn string, execution_order int, dd_ordinal int, step string, access_type string, dataset_kind string", [
        ("f", "J", d, o, i, f"S{o}", a, k) for d, o, i, a, k in [("A", 1, 1, "read", "persistent"), ("A", 2, 1, "write", "persistent"), ("A", 3, 1, "read", "persistent"), ("A", 3, 2, "read", None), ("A", 4, 1, "delete", None), ("B", 1, 2, "control", None), ("B", 5, 1, "write", "temporary"), ("C", 2, 2, "write", None), ("C", 2, 3, "write", "system"), ("C", 6, 1, "unknown", "system"), ("D", 7, 1, "read", "persistent")]
    ]),
    "fx_steps": ("file string, seq int, step string, scope string, defined_in_proc string, program string, proc string, exec_kind string, resolved_locally boolean", [
        ("f", 1, "P1", "procedure_definition", "PR", "X", None, "program", False), ("f", 2, "P2", "procedure_definition", "PR", "Y", None, "program", False), ("f", 3, "S1", "job", None, "A", None, "program", False), ("f", 4, "S2", "job", None, None, "PR", "procedure", True),
        ("f", 5, "S3", "job", None, None, "GONE", "procedure", False), ("f", 6, "S4", "job", None, None, "PR", "procedure", True), ("g", 1, "S1", "job", None, "A", None, "program", False),
    ]),
    "fx_vars": ("program string, variable string, origin string", [("P", "A-1", "WORKING-STORAGE"), ("P", "A-2", "COPY:PDCBVCM"), ("P", "B", "UNKNOWN"), ("Q", "A-1", "LINKAGE"), ("Q", "C", "WORKING-STORAGE"), ("P", "PD1FS00-X", "COMMAREA")]),
    "fx_sites": ("program string, variable string, kind string, paragraph string, line int, statement string, targets string", [
        ("P", "A-1", "write", "INIT", 10, "MOVE 'X' TO A-1", ""), ("P", "A-1", "write", "MAIN", 20, "MOVE B TO A-1", ""), ("P", "A-1", "read", "MAIN", 30, "MOVE A-1 TO B", ""), ("P", "A-1", "control", "MAIN", -1, "A-1 = 'X'", "EXIT-P,OUT"),
        ("P", "A-2", "write", "INIT", 12, "MOVE +12.5 TO A-2", ""), ("P", "A-2", "write", "INIT", 12, "MOVE +12.5 TO A-2", ""), ("P", "B", "read", "MAIN", 20, "MOVE B TO A-1", ""), ("P", "B", "write", "MAIN", 30, "MOVE A-1 TO B", ""),
        ("Q", "A-1", "read", "TOP", 5, "DISPLAY A-1", ""), ("P", "PD1FS00-X", "write", "MAIN", 25, 'MOVE "a" TO PD1FS00-X', ""), ("P", "PD1FS00-X", "read", "MAIN", 45, "IF PD1FS00-X = 1", ""),
    ]),
    "fx_programs": ("program string, cobol_count int, manifest_valid boolean, has_mapa boolean, has_controlflow boolean, copybook_count int, missing_copybooks int", [
        ("A", 1, True, True, True, 3, 0), ("B", 0, True, True, True, 3, 0), ("C", 2, None, True, True, 0, 0), ("D", 1, False, True, True, 2, 2), ("E", 1, True, False, False, 1, 0), ("F", 1, True, True, True, 1, 0),
    ]),
    "fx_outputs": ("program string, invalid_json int, n_missing int", [("A", 0, 0), ("B", 0, 0), ("C", 0, 0), ("D", 0, 7), ("E", 2, 1), ("G", 0, 0)]),
}


def frame(spark: SparkSession, name: str) -> DataFrame:
    schema, rows = FIXTURES[name]
    return spark.createDataFrame(rows, schema)


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).upper()
    return str(value) if isinstance(value, int) else "'" + value.replace("'", "''") + "'"


def sql(name: str) -> str:
    """A common table expression with the fixture's rows."""
    schema, rows = FIXTURES[name]
    types = {"string": "VARCHAR", "int": "INTEGER", "boolean": "BOOLEAN"}
    fields = [f.split() for f in schema.split(", ")]
    values = ", ".join("(" + ", ".join(map(_literal, r)) + ")" for r in rows)
    casts = ", ".join(f"CAST({n} AS {types[t]}) AS {n}" for n, t in fields)
    return f"{name} AS (SELECT {casts} FROM (VALUES {values}) AS v({', '.join(n for n, _ in fields)}))"
